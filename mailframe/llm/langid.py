"""Language identification with string kernels.

The kernel of two texts is the number of byte n-grams (all n up to ``MAX_N``, the blended
spectrum) that both contain, divided by the root of the product of their own numbers.
Nyström landmarks turn it into a fixed number of features; one-versus-rest kernel ridge
regression is fitted on them.  Texts are scored in blocks: presence matrix times landmark
matrix, scaled, times weights.

Presence is kept in ``BINS`` hashed bins.  A text above ``PIECE`` bytes would fill them, so it is
cut into pieces; its scores are the means of its pieces' scores, weighted by their bytes.

A text's coverage is its kernel with all sampled texts of a label at once: the share of its
n-grams that any of them holds, for the label where that is largest.  ``LanguageModel.bound``
derives from the sample what a text of a learned language reaches; below it a text is
written in none of them (``in_learned_language``), whatever label scores best.

The model is fitted on a bounded sample: about ``PER_LABEL`` labelled rows of each label,
taken by a hash over all labelled rows, of long texts one piece.  Everything else covers every row and whole texts.

Defined results: null text, and text without a letter, gives ``und`` with score 0; without
any labelled text every text is ``und``; repeated rows get equal results; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import ALNUM_WORDS, bounded_batches, text_chunks

MAX_N = 4
BINS = 1 << 15
PER_LABEL = 300
#: Landmarks of each label.
LANDMARKS = 16
RIDGE = 1e-2
UNKNOWN = "und"
#: Texts in one matrix product.
BLOCK = 128
#: Bytes of text that share one row of bins.
PIECE = 1 << 16
#: What a text must reach of the coverage that all but ``OUTLIERS`` of the sampled texts have by the others (some may be labelled wrongly).
MARGIN = 0.7
OUTLIERS = 0.05


def presence(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """0/1 matrix (text x bin): which hashed n-grams a text contains. Anything but letters counts as one gap."""
    low = ALNUM_WORDS[data]
    low[(low >= 48) & (low <= 57)] = 0
    n = len(offs) - 1
    out = np.zeros((n, BINS), np.uint8)
    row = np.repeat(np.arange(n, dtype=np.int64) * BINS, np.diff(offs))
    left = np.repeat(offs[1:], np.diff(offs)) - np.arange(len(low))  # bytes up to the text's end
    gap = low == 0
    code = np.zeros(len(low), np.uint32)
    flat = out.reshape(-1)
    empty = np.ones(len(low), bool)
    for k in range(min(MAX_N, len(low))):
        code[: len(low) - k] = code[: len(low) - k] * np.uint32(257) + low[k:] + np.uint32(1)
        empty[: len(low) - k] &= gap[k:]
        x = (code + np.uint32(k)) * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA77)
        ok = (left > k) & ~empty
        flat[(row + (x >> np.uint32(32 - 15)))[ok]] = 1
    return out


@dataclass
class LanguageModel:
    labels: list[str]
    landmarks: np.ndarray  # landmark x bin, each row divided by the root of its own number
    weights: np.ndarray  # landmark x label
    union: np.ndarray  # label x bin, 0/1: what any sampled text of the label holds
    bound: float  # least coverage of a text in a learned language

    def coverage(self, bits: np.ndarray) -> np.ndarray:
        return (bits.astype(np.float32) @ self.union.T).max(axis=1) / np.maximum(bits.sum(axis=1, dtype=np.int64), 1)

    def kernel(self, bits: np.ndarray) -> np.ndarray:
        block = bits.astype(np.float32)
        own = np.sqrt(np.maximum(bits.sum(axis=1, dtype=np.int64), 1)).astype(np.float32)
        return (block @ self.landmarks.T) / own[:, None]

    def scores(self, bits: np.ndarray) -> np.ndarray:
        return self.kernel(bits) @ self.weights


def fit_kernel_ridge(bits: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel | None:
    """Nyström features from landmarks dealt evenly over the labels, then one ridge regression per label."""
    if not len(labels):
        return None
    names = sorted(set(labels))
    label = np.array([names.index(x) for x in labels])
    turn = np.zeros(len(label), np.int64)
    for k in range(len(names)):
        turn[label == k] = np.arange((label == k).sum())
    chosen = np.lexsort((label, turn))[: int((turn < landmarks).sum())]
    marks = bits[chosen].astype(np.float32)
    marks /= np.sqrt(np.maximum(marks.sum(axis=1), 1))[:, None]
    union = np.stack([bits[label == k].any(axis=0) for k in range(len(names))]).astype(np.float32)
    model = LanguageModel(names, marks, np.zeros((len(chosen), len(names)), np.float32), union, _usual_coverage(bits, label, turn) * MARGIN)
    inner = (marks @ marks.T).astype(np.float64)
    value, vector = np.linalg.eigh(inner)
    good = value > 1e-6 * max(value.max(), 1e-12)
    root = vector[:, good] / np.sqrt(value[good])  # kernel row -> Nyström features
    phi = np.concatenate([model.kernel(bits[i : i + BLOCK]) for i in range(0, len(bits), BLOCK)]).astype(np.float64) @ root
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    solved = np.linalg.solve(phi.T @ phi + ridge * len(bits) * np.eye(phi.shape[1]), phi.T @ target)
    model.weights = (root @ solved).astype(np.float32)
    return model


def _usual_coverage(bits: np.ndarray, label: np.ndarray, turn: np.ndarray) -> float:
    """The share of a text's n-grams that texts of its label in the other half of the sample hold, for all but ``OUTLIERS`` of the texts; 0 if no label has two."""
    found = []
    for k in np.unique(label):
        for half in (0, 1):
            mine, others = bits[(label == k) & (turn % 2 == half)], bits[(label == k) & (turn % 2 != half)]
            if len(mine) and len(others):
                held = mine.astype(np.float32) @ others.any(axis=0).astype(np.float32)
                found.append(held / np.maximum(mine.sum(axis=1, dtype=np.int64), 1))
    return float(np.quantile(np.concatenate(found), OUTLIERS)) if found else 0.0


def pieces(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the pieces of all texts, first piece of each text); an empty text is one empty piece."""
    count = np.maximum(1, -(-np.diff(offs) // PIECE))
    first = np.concatenate([[0], np.cumsum(count)])
    starts = np.repeat(offs[:-1], count) + (np.arange(first[-1]) - np.repeat(first[:-1], count)) * PIECE
    return np.append(starts, offs[-1]), first[:-1]


def labelled_sample(rows: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """About ``per_label`` rows (key, label, text) of each label, by a hash over all of them."""
    rows = rows.filter(F.col("label").isNotNull())
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("label") == name, F.lit(min(1.0, per_label / n))).otherwise(share)
    place = F.pmod(F.xxhash64("key", F.length("text")), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(place < share)


def fit(rows: DataFrame, per_label: int = PER_LABEL) -> LanguageModel | None:
    """Fit on rows (key, label, text). Only the sample's bit vectors (``BINS`` bits a row) come to the driver."""
    bounded_batches(rows.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in text_chunks(batch, limit=1 << 19):
                cut, first = pieces(offs)
                one = first + np.diff(offs) % np.diff(np.append(first, len(cut) - 1))  # of long texts a piece anywhere in them
                bits = np.stack([np.packbits(presence(data[cut[i] : cut[i + 1]], cut[i : i + 2] - cut[i])[0]) for i in one])
                yield pa.RecordBatch.from_arrays([part["label"], pa.array([b.tobytes() for b in bits], pa.binary())], names=["label", "bits"])

    sample = labelled_sample(rows, per_label).select("label", "text").mapInArrow(features, "label string, bits binary").collect()
    sample.sort(key=lambda r: (r["label"], bytes(r["bits"])))
    bits = [np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in sample]
    return fit_kernel_ridge(np.array(bits, np.uint8).reshape(len(bits), BINS), [r["label"] for r in sample])


def identify(df: DataFrame, model: LanguageModel | None, text: Column) -> Column:
    """Column struct<lang_pred string, score double, coverage double> for the whole text."""
    bounded_batches(df.sparkSession)
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("coverage"))
    if model is None:
        return none
    shared = df.sparkSession.sparkContext.broadcast(model)  # LANDMARKS x BINS numbers, whatever the input

    def classify(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        names = np.array(model.labels, object)
        for texts in columns:
            best, score, covered = [], [], []
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            for _, data, offs in text_chunks(batch, limit=1 << 19):
                cut, first = pieces(offs)
                got, share = np.zeros((len(cut) - 1, len(names))), np.zeros(len(cut) - 1)
                for lo in range(0, len(share), BLOCK):
                    at = cut[lo : lo + BLOCK + 1]
                    bits = presence(data[at[0] : at[-1]], at - at[0])
                    got[lo : lo + BLOCK], share[lo : lo + BLOCK] = model.scores(bits), model.coverage(bits)
                size = np.maximum(np.diff(cut), 1)
                weight = size / np.repeat(np.add.reduceat(size, first), np.diff(np.append(first, len(size))))
                mean = np.add.reduceat(got * weight[:, None], first)
                top = mean.argmax(axis=1)
                best.append(names[top])
                score.append(np.clip((mean[np.arange(len(top)), top] + 1) / 2, 0.0, 1.0))
                covered.append(np.clip(np.add.reduceat(share * weight, first), 0.0, 1.0))
            doubles = [pa.array(np.concatenate(x) if x else [], pa.float64()) for x in (score, covered)]
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(best) if best else [], pa.string()), *doubles], names=["lang_pred", "score", "coverage"])

    guess = F.arrow_udf(classify, "struct<lang_pred string, score double, coverage double>")(text)
    return F.when(text.rlike(r"\p{L}"), guess).otherwise(none)


def in_learned_language(df: DataFrame, model: LanguageModel | None, text: Column) -> Column:
    """Whether the text is in a learned language: it has a letter and its coverage reaches the model's bound. Without a model, whether it has a letter."""
    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return letter if model is None else letter & (identify(df, model, text)["coverage"] >= model.bound)


def with_language(df: DataFrame, model: LanguageModel | None, text_col: str, lang_col: str) -> DataFrame:
    """The rows whose text is in a learned language (``in_learned_language``), with the predicted one as ``lang_col``; without a model ``und``."""
    text = F.col(text_col)
    if model is None:
        return df.filter(in_learned_language(df, None, text)).withColumn(lang_col, F.lit(UNKNOWN))
    # exploded from an array of one: a filter on a plain column would move below it and score every text twice
    guess = F.explode(F.array(identify(df, model, text)))
    rows = df.filter(text.rlike(r"\p{L}")).select("*", guess.alias("_guess")).filter(F.col("_guess.coverage") >= model.bound)
    return rows.select(*[F.col("_guess.lang_pred").alias(c) if c == lang_col else c for c in df.columns])
