"""Hard-negative mining with exact inner products by the Method of Four Russians.

Vectors are integers.  For a block of anchors and every group of eight dimensions a table
holds all 256 subset sums of the anchors' components.  A candidate is held as bit planes in
two's complement, each packed to one byte for eight dimensions: a plane's inner product with
all anchors is one table row for each of its bytes, and shifting and adding the planes (the
highest is negative) gives the full exact scores.

Anchors come in blocks of bounded size; every block is sent to the tasks, which score all rows
where they lie.  A first pass finds every anchor's best rows of its own label (positives), a
second one, for each positive, the best rows of other labels whose score lies between
``LOW`` and ``HIGH`` per cent of the positive's.  Tasks send their own best of each list, so
what is shuffled grows with the tasks, not with the rows, and no label gathers anywhere.

Defined results: rows with a null label, a null vector, or null or non-finite components take
no part, nor do rows whose length is not that of the smallest id.  Ties go to the smaller id;
a null id comes last and is no anchor.  Repeated rows each count, repeated anchors each give
their rows, and a row with the anchor's id is neither positive nor negative.  Components are
held to +-``LIMIT``.  An empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailframe.llm.vectors import integer_vectors, matrix
from mailframe.session import checkpoint_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Per cent of the positive's score between which a negative's lies.
LOW, HIGH = 30, 90
LIMIT = 1 << 22
#: Anchors in a block: at most this many, and no more than a table of TABLE_BYTES holds.
ANCHORS = 1024
TABLE_BYTES = 32 << 20
#: Candidates that are scored at once.
CHUNK = 1024
#: Stands for a null id in comparisons.
LAST_ID = np.iinfo(np.int64).max


class Scorer:
    """Subset-sum tables of a block of anchors."""

    def __init__(self, anchors: np.ndarray):
        n, dim = anchors.shape
        self.anchors, self.groups = n, -(-dim // 8)
        padded = np.zeros((n, self.groups * 8), np.int64)
        padded[:, :dim] = anchors
        self.reach = int(np.abs(padded).sum(1).max(initial=0))  # bounds |score| by a candidate's largest component
        self.tables = np.zeros((self.groups, 256, n), np.int64)
        for g in range(self.groups):
            for bit in range(8):
                self.tables[g, 1 << bit : 2 << bit] = self.tables[g, : 1 << bit] + padded[:, 8 * g + bit]
        self.narrow = self.tables.astype(np.int32) if self.reach < 1 << 31 else None

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Inner products of every row with every anchor."""
        padded = np.zeros((len(rows), self.groups * 8), np.int64)
        padded[:, : rows.shape[1]] = rows
        planes = int(max(padded.max(initial=0), -1 - padded.min(initial=0))).bit_length() + 1
        small = self.narrow is not None and self.reach << planes < 1 << 31
        tables = self.narrow if small else self.tables
        out = np.zeros((len(rows), self.anchors), tables.dtype)
        part = np.empty_like(out)
        for plane in reversed(range(planes)):
            packed = np.packbits(((padded >> plane) & 1).astype(np.uint8), axis=1, bitorder="little")
            out <<= 1
            for g in range(self.groups):
                np.take(tables[g], packed[:, g], axis=0, out=part)
                if plane == planes - 1:
                    out -= part
                else:
                    out += part
        return out.astype(np.int64)


class Best:
    """The ``k`` best (score, id) of every list, ties to the smaller id."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.least = np.full(lists, np.iinfo(np.int64).min)  # k-th best score so far
        self.list, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray, first: int = 0) -> None:
        """A matrix of scores (row: candidate, column: list ``first`` and on), of which the allowed ones count."""
        fit = allowed & (score >= self.least[first : first + score.shape[1]])
        if len(score) > self.k and np.count_nonzero(fit) > 4 * self.k * score.shape[1]:  # the k-th best of the chunk bounds each list
            fit &= score >= np.partition(np.where(fit, score, np.iinfo(np.int64).min), -self.k, axis=0)[-self.k]
        row, col = np.nonzero(fit)
        if len(row):
            self._merge(col + first, score[row, col], ids[row])

    def _merge(self, which: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        which, score, ids = np.concatenate([self.list, which]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, which))
        which, score, ids = which[order], score[order], ids[order]
        start = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
        rank = np.arange(len(which)) - np.repeat(start, np.diff(np.r_[start, len(which)]))
        kept = rank < self.k
        self.list, self.score, self.id = which[kept], score[kept], ids[kept]
        full = rank == self.k - 1
        self.least[which[full]] = score[full]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.list, self.score, self.id)], ["list", "score", "id"])


BEST = "list bigint, score bigint, id bigint"


def _candidates(batches: Iterator[pa.RecordBatch], scorer: Scorer, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(scores, ids, labels) of every chunk."""
    for batch in batches:
        for lo in range(0, batch.num_rows, CHUNK):
            rows = batch.slice(lo, CHUNK)
            ids = rows.column("id").fill_null(LAST_ID).to_numpy(zero_copy_only=False)
            yield scorer.scores(matrix(rows.column("v"), dim, dim)), ids, rows.column("label").to_numpy(zero_copy_only=False)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every list over all tasks, with their rank."""
    order = Window.partitionBy("list").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _mine_block(vectors: DataFrame, block: list, dim: int) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for a block of anchor rows."""
    anchor_ids = np.array([r["id"] for r in block], np.int64)
    labels = np.array([r["label"] for r in block], np.int64)
    components = np.array([r["v"] for r in block], np.int64).reshape(len(block), dim)

    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchor_ids), POSITIVES)
        for score, ids, own in _candidates(batches, Scorer(components), dim):
            best.add(score, ids, (own[:, None] == labels) & (ids[:, None] != anchor_ids))
        yield best.batch()

    found = _ranked(vectors.mapInArrow(positives, BEST), POSITIVES).collect()  # at most POSITIVES for each anchor of the block
    goal = np.zeros((POSITIVES, len(block)), np.int64)
    there = np.zeros((POSITIVES, len(block)), bool)
    for r in found:
        goal[r["rank"] - 1, r["list"]], there[r["rank"] - 1, r["list"]] = r["score"], True

    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(POSITIVES * len(anchor_ids), NEGATIVES)
        for score, ids, own in _candidates(batches, Scorer(components), dim):
            other = (own[:, None] != labels) & (ids[:, None] != anchor_ids)
            for p in range(POSITIVES):
                fits = (100 * score >= LOW * goal[p]) & (100 * score <= HIGH * goal[p])
                best.add(score, ids, other & there[p] & fits, first=p * len(anchor_ids))
        yield best.batch()

    spark = vectors.sparkSession
    n = len(block)
    pairs = [((r["rank"] - 1) * n + r["list"], int(anchor_ids[r["list"]]), r["id"], r["score"]) for r in found]
    wanted = spark.createDataFrame(pairs, "list bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    known = lambda c: F.when(F.col(c) != int(LAST_ID), F.col(c)).alias(c)
    ranked = _ranked(vectors.mapInArrow(negatives, BEST), NEGATIVES).select("list", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return ranked.join(F.broadcast(wanted), "list").select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """Hard negatives of every anchor row (``is_anchor``, by the columns of ``rows``)."""
    keep = {"id": F.col(id_col).cast("bigint"), "label": F.col(label_col).cast("bigint"), "anchor": F.coalesce(is_anchor, F.lit(False)) & F.col(id_col).isNotNull()}
    vectors, first = integer_vectors(rows.filter(F.col(label_col).isNotNull()), SCALE, LIMIT, keep, vector_col)
    path = checkpoint_path(rows.sparkSession, f"hard-negatives-{uuid.uuid4().hex}")
    rows.sparkSession.createDataFrame([], RESULT).write.parquet(path)
    if first:
        dim = len(first[0]["v"])
        size = max(1, min(ANCHORS, TABLE_BYTES // (256 * 8 * max(1, -(-dim // 8)))))
        columns = vectors.select("id", "label", "v")
        # One partition of anchors at a time comes to the driver, one block at a time goes to the tasks.
        for block in itertools.batched(vectors.filter("anchor").select("id", "label", "v").toLocalIterator(), size):
            _mine_block(columns, list(block), dim).write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(RESULT).parquet(path)


MINE_SQL = f"""
WITH good AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM good a JOIN good b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s USING (anchor_id)
WHERE NOT s.same AND {LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
