"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words, neighbouring pairs and pairs with one word between of a text, hashed
into ``BINS`` bins, each present or not.  Every coordinate has its own learning rate; the L1
term keeps most weights at exactly zero, so the model is a short list of (bin, weight).

Training takes a bounded sample: the ``TRAIN_ROWS`` labelled rows with the least hash.  Their
features are extracted side by side; one pass over them, in hash order, learns online and
holds nothing but the model.  Scoring covers every row and whole texts.

Defined results: null and empty text are scored by the bias alone; without labelled rows
every score is 0.5; null labels are not learned from; repeated rows
get equal scores; texts may have any length; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import bounded_batches, mix64, segment_ids, text_chunks, word_hashes

BINS = 1 << 20
TRAIN_ROWS = 24_000
ALPHA, BETA, L1, L2 = 0.3, 1.0, 2.0, 1.0
BIAS = 0  # the bin that every text has

_FIRST, _SECOND, _SKIP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def features(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bin) arrays of the words, pairs and skip-pairs of some texts, repeats included."""
    words, first = word_hashes(data, offs)
    row = segment_ids(first)
    for gap in (0, 1, 2):
        n = max(len(words) - gap, 0)
        same = row[:n] == row[gap:]
        x = words if not gap else words[:n] * _FIRST + words[gap:] * _SECOND + (_SKIP if gap == 2 else np.uint64(0))
        bins = (mix64(x) >> np.uint64(32)).astype(np.int64) & (BINS - 1)
        bins[bins == BIAS] = 1
        yield row[:n][same], bins[same]


def bag(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Distinct bins of each text, the bias included."""
    rows, bins = zip(*features(data, offs), strict=True)
    keys = np.unique(np.concatenate(rows) * BINS + np.concatenate(bins))
    cuts = np.searchsorted(keys, np.arange(len(offs)) * BINS)
    return [np.r_[BIAS, keys[a:b] - k * BINS].astype(np.uint32) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


class FtrlProximal:
    """Per-coordinate FTRL-proximal with L1 and L2, one example at a time."""

    def __init__(self, bins: int = BINS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(bins), np.zeros(bins)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, x: np.ndarray) -> np.ndarray:
        z = self.z[x]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[x])) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0.0
        return w

    def update(self, x: np.ndarray, label: int) -> None:
        w = self.weights(x)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[x]
        self.z[x] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[x] = n + g * g


@dataclass
class ToxicityModel:
    bins: np.ndarray
    weights: np.ndarray


def fit(rows: DataFrame) -> ToxicityModel:
    """Fit on rows (place, label 0/1, text), sampled beforehand, in the order of ``place``."""
    bounded_batches(rows.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in text_chunks(batch):
                bags = [x.tobytes() for x in bag(data, offs)]
                yield pa.RecordBatch.from_arrays([part["place"], part["label"], pa.array(bags, pa.binary())], names=["place", "label", "bag"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = FtrlProximal()
        for batch in batches:
            for x, label in zip(batch["bag"], batch["label"].to_pylist(), strict=True):
                model.update(np.frombuffer(x.as_buffer(), np.uint32), label)
        bins = np.flatnonzero(np.abs(model.z) > model.l1)
        yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(model.weights(bins))], names=["bin", "weight"])

    bags = rows.filter(F.col("label").isNotNull()).select("place", F.col("label").cast("int").alias("label"), "text").mapInArrow(extract, "place bigint, label int, bag binary")
    learned = bags.repartition(1).sortWithinPartitions("place", "label", "bag").mapInArrow(learn, "bin bigint, weight double")
    table = learned.toArrow()  # BINS rows at most
    return ToxicityModel(table["bin"].to_numpy(), table["weight"].to_numpy())


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(place, label, text) of the ``rows`` labelled documents with the least hash; the sample is small by its bound, so it is broadcast."""
    known = labels.filter(F.col("toxic").isNotNull()).select(F.col("doc_id").alias("labelled"), F.col("toxic").alias("label"))
    sample = known.withColumn("place", F.xxhash64("labelled")).orderBy("place", "labelled", "label").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("labelled")).select("place", "label", "text")


def score(df: DataFrame, model: ToxicityModel, text: Column) -> Column:
    """Probability column for the whole text."""
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most BINS weights, mostly far fewer

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        table = np.zeros(BINS)
        table[model.bins] = model.weights
        for texts in columns:
            out = [np.zeros(0)]
            for _, data, offs in text_chunks(pa.RecordBatch.from_arrays([texts], names=["text"])):
                keys = []
                for row, bins in features(data, offs):
                    heavy = np.flatnonzero(table[bins])  # only bins with a weight matter
                    keys.append(row[heavy] * BINS + bins[heavy])
                keys = np.unique(np.concatenate(keys))
                total = table[BIAS] + np.bincount(keys // BINS, table[keys % BINS], len(offs) - 1)
                out.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
            yield pa.array(np.concatenate(out), pa.float64())

    return F.arrow_udf(run, "double")(text)
