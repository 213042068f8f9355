"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

A vector of integers is cut into ``PARTS`` equal parts (zeros fill the last one where the
length does not divide).  Every part position has a codebook of ``ENTRIES`` entries; a part's
code is the index of its nearest entry by squared Euclidean distance, ties to the lower index.
Codebooks start as the parts of the rows with the smallest ids; each of ``ROUNDS`` rounds
assigns all parts and replaces every entry by the componentwise floor of its parts' mean.

Orchard's search keeps, for every entry, the list of all entries by distance from it.  A
search walks the list of the best entry so far: an entry that is nearer to the part makes the
search jump to that entry's list, every entry is measured once, and the walk ends at an entry
farther from the best one than twice the best distance, as no entry from there on can be as
near.  All distances are exact integers, so ties are exact too.

A round is one pass over the written vectors: every task sends the sums and counts of its
parts by codebook entry, and only the codebooks (16 rows of the table) come to the driver.

Defined results: rows with a null vector, or null or non-finite components, are dropped, and
so are rows whose length is not that of the smallest id.  Components are held to what lets
squared distances fit a long (beyond +-60,000 for 64 dimensions).  Fewer than 16 rows make
codebooks of fewer entries.  Equal ids are ordered by their vectors; repeated rows each
count; a null id comes last; null labels are one label; an empty table gives no rows;
extra columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import scratch_table
from mailframe.llm.vectors import integer_vectors, matrix

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors that are searched at once.
CHUNK = 4096


class Codebook:
    """Entries of one part position with the distance-sorted neighbour list of each."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        self.lists = np.argsort(self.gaps, axis=1, kind="stable")

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of every row, by Orchard's search."""
        n, size = len(parts), len(self.entries)
        best = np.zeros(n, np.int64)
        away = ((parts - self.entries[0]) ** 2).sum(1)
        marked = np.ones(n, np.int64)  # bit per measured entry
        at = np.zeros(n, np.int64)  # place in the best entry's list
        live = np.arange(n)
        while len(live):
            here = best[live]
            other = self.lists[here, at[live]]
            near = self.gaps[here, other] <= 4 * away[live]  # else beyond twice the best distance, with all that follow
            fresh = near & ((marked[live] >> other) & 1 == 0)
            who, entry = live[fresh], other[fresh]
            found = ((parts[who] - self.entries[entry]) ** 2).sum(1)
            marked[who] |= 1 << entry
            at[live] += 1
            better = (found < away[who]) | ((found == away[who]) & (entry < best[who]))
            jump = who[better]
            best[jump], away[jump], at[jump] = entry[better], found[better], 0
            live = live[near & (at[live] < size)]
        return best, away


def _limit(width: int) -> int:
    """Largest component for which four times a squared distance fits a long."""
    return math.isqrt((1 << 58) // max(width, 1))


def _search(batches: Iterator[pa.RecordBatch], books: list[Codebook], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, parts, codes, squared distances) of every chunk."""
    width = books[0].entries.shape[1]
    for batch in batches:
        for lo in range(0, batch.num_rows, CHUNK):
            rows = batch.slice(lo, CHUNK)
            parts = matrix(rows.column("v"), dim, PARTS * width).reshape(-1, PARTS, width)
            found = [book.nearest(parts[:, p]) for p, book in enumerate(books)]
            yield rows, parts, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _moved(vectors: DataFrame, books: list[Codebook], dim: int) -> list[Codebook]:
    """One round: every entry becomes the floored mean of the parts assigned to it."""
    size, width = books[0].entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, size, width), np.int64)
        count = np.zeros((PARTS, size), np.int64)
        for _, parts, codes, _ in _search(batches, books, dim):
            for p in range(PARTS):
                np.add.at(total[p], codes[:, p], parts[:, p])
                count[p] += np.bincount(codes[:, p], minlength=size)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    by_task = vectors.select("v").mapInArrow(sums, "part bigint, entry bigint, n bigint, sums array<bigint>")
    each = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    entries = [book.entries.copy() for book in books]
    for row in by_task.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():  # PARTS x ENTRIES rows
        entries[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return [Codebook(e) for e in entries]


def _hex(codes: np.ndarray) -> pa.Array:
    """Two hexadecimal digits of every code of a row, in order."""
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)
    text = np.stack([digits[codes >> 4], digits[codes & 15]], 2).astype(np.uint8)
    offsets = np.arange(len(codes) + 1, dtype=np.int32) * (2 * PARTS)
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(offsets.tobytes()), pa.py_buffer(text.tobytes()))


RESULT = "vec_id bigint, label int, code string, error bigint"


def compress(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable row."""
    dims = rows.agg(F.max(F.size(vector_col))).first()[0] or 0
    keep = {"id": F.col(id_col).cast("bigint"), "label": F.col(label_col).cast("int")}
    vectors, first = integer_vectors(rows, SCALE, _limit(-(-max(dims, 0) // PARTS)), keep, vector_col)
    if not first:
        return rows.sparkSession.createDataFrame([], f"{RESULT}, label_error bigint, codebooks_sha256 string")
    dim = len(first[0]["v"])
    width = -(-dim // PARTS)
    start = np.zeros((len(first), PARTS * width), np.int64)
    start[:, :dim] = [r["v"] for r in first]
    books = [Codebook(start.reshape(-1, PARTS, width)[:, p].copy()) for p in range(PARTS)]
    for _ in range(ROUNDS):
        books = _moved(vectors, books, dim)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, found, away in _search(batches, books, dim):
            yield pa.RecordBatch.from_arrays([chunk.column("id"), chunk.column("label"), _hex(found), pa.array(away.sum(1))], ["vec_id", "label", "code", "error"])

    coded = scratch_table(vectors.select("id", "label", "v").mapInArrow(codes, RESULT), "codes")
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    text = ",".join(str(x) for book in books for x in book.entries.ravel().tolist())
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    return joined.withColumn("codebooks_sha256", F.lit(hashlib.sha256(text.encode()).hexdigest()))


def _sql() -> str:
    """All rounds as one chain of tables: for every round the parts' nearest entries and the entries' floored means."""
    near = "SELECT x.vec_id, x.label, x.p, x.v, min({'d': list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': b.e}) AS best FROM parts x JOIN b%d b USING (p) GROUP BY ALL"
    steps = []
    for i in range(ROUNDS):
        steps.append(f"""a{i} AS MATERIALIZED ({near % i}),
m{i} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS v FROM (
  SELECT p, best.e AS e, k, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT p, best, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM a{i}) GROUP BY 1, 2, 3) GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN m{i} m ON b.p = m.p AND b.e = m.e)""")
    return f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, label, p, list_slice(v, p * len(v) // {PARTS} + 1, (p + 1) * len(v) // {PARTS}) AS v FROM whole, range({PARTS}) t(p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts QUALIFY e < {ENTRIES}),
{", ".join(steps)},
last AS ({near % ROUNDS}),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM last GROUP BY 1, 2)
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded
"""


CODE_SQL = _sql()
