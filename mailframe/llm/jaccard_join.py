"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with the same set of word shingles form a copy class; the join runs between
classes.  MinHash values are compared band by band: classes that agree on all values of a
band share a bucket.  Inside a bucket the values of a pair are compared ``STEP`` at a time;
with m of n equal, the posterior of the similarity (uniform prior) tells how likely it is
to reach the threshold, and the pair is dropped once that falls below ``TOLERANCE``.  What
is left is verified exactly on the shingle sets.

A bucket larger than ``BLOCK`` is dealt into blocks, and blocks meet in pairs, so that no
task holds a bucket.  No pair becomes a row or an element of one: the comparison returns which
classes have a partner left, those classes' shingle sets join them in the same unit, the
comparison is made again and its pairs are verified, and a task returns each class's number of links
and a spanning star of what it linked.  A pair counts in the first band it shares, once.

With 32 bands of 5 values a pair at the threshold of 0.8 is missed with probability 3e-6.

Defined results: words are runs of letters and digits, lower-cased; a text of one to four
words is one shingle; a text without words (null, empty) links to nothing and is its own
class; identical sets are copies and count as links; repeated rows are copies of each other;
ids may be null or repeated; texts may have any length; an empty table gives no rows; other
columns, whatever their names, are not read (``one_of_each`` passes them on).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import bounded_batches, mix64, scratch_table, shuffle_partitions, text_chunks, word_hashes
from mailframe.llm.components import connected

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP = 32
TOLERANCE = 1e-6
BLOCK = 512

_PLACE = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WORDS)], np.uint64)
_RANDOM = np.random.default_rng(6)
_XOR = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_TIMES = _RANDOM.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all word shingles, first shingle of each row and the total)."""
    words, first = word_hashes(data, offs)
    counts = np.diff(first)
    number = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    start = np.concatenate([[0], np.cumsum(number)])
    at = np.arange(start[-1]) + np.repeat(first[:-1] - start[:-1], number)  # first word of each shingle
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    size = np.repeat(np.minimum(counts, WORDS), number)
    total = size.astype(np.uint64)
    for k in range(WORDS):
        total += np.where(size > k, padded[at + k], np.uint64(0)) * _PLACE[k]
    return mix64(total), start


def signatures(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """16-bit MinHash values (row x HASHES); rows without shingles get zeros."""
    full = np.flatnonzero(np.diff(start))
    out = np.zeros((len(start) - 1, HASHES), np.uint16)
    if not len(full):
        return out
    x, first = (hashes >> np.uint64(32)).astype(np.uint32), start[full]
    for k in range(HASHES):
        h = (x ^ _XOR[k]) * _TIMES[k]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out[full, k] = (np.minimum.reduceat(h, first) * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n compared values, the least number of equal ones that keeps a pair.

    The posterior of the similarity after m of n is Beta(m + 1, n - m + 1); its tail above
    the threshold is the chance of fewer than m + 1 successes in n + 1 trials at the threshold.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                out[n] = m
                break
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offs in text_chunks(batch):
            hashes, start = shingles(data, offs)
            sig = signatures(hashes, start)
            sets = [np.unique(hashes[a:b]) for a, b in zip(start[:-1], start[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    part["text_hash"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sig], pa.binary()),
                ],
                names=["doc_id", "text_hash", "n", "digest", "sig"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the texts whose set is the wanted one (ids may repeat)."""
    for batch in batches:
        for part, data, offs in text_chunks(batch):
            hashes, start = shingles(data, offs)
            cid, found = [], []
            for c, want, a, b in zip(part["cid"].to_pylist(), part["digest"].to_pylist(), start[:-1], start[1:], strict=True):
                s = np.unique(hashes[a:b])
                if xxhash.xxh3_128_digest(s) == want:
                    cid.append(c)
                    found.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(found, pa.binary())], names=["cid", "shingles"])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Regroup batches sorted by ``unit`` so that no unit is split; a unit has about two blocks at most."""
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table]).combine_chunks()
        units = table["unit"].to_numpy()
        cut = int(np.flatnonzero(units != units[-1])[-1]) + 1 if len(units) and units[0] != units[-1] else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        kept = table.slice(cut)
    if kept is not None and kept.num_rows:
        yield kept.combine_chunks()


def _candidate_pairs(unit: np.ndarray, lo: np.ndarray, hi: np.ndarray, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs that a unit stands for: within one block, or across its two; some 100,000 at a time."""
    edges = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True])
    left, right, n = [], [], 0
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if lo[a] == hi[a]:
            i, j = np.triu_indices(b - a, 1)
        else:
            own = block[a:b] == lo[a]
            x, y = np.flatnonzero(own), np.flatnonzero(~own)
            i, j = np.repeat(x, len(y)), np.tile(y, len(x))
        left.append(i + a)
        right.append(j + a)
        n += len(i)
        if n >= 100_000:
            yield np.concatenate(left), np.concatenate(right)
            left, right, n = [], [], 0
    if n:
        yield np.concatenate(left), np.concatenate(right)


def bayes_prune(sig: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that outlive every step of the incremental comparison."""
    small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    keep = small >= threshold * large  # else the sizes alone rule the threshold out
    i, j = i[keep], j[keep]
    equal = np.zeros(len(i), np.int64)
    for n, least in least_matches(threshold).items():
        equal += (sig[i, n - STEP : n] == sig[j, n - STEP : n]).sum(axis=1)
        keep = equal >= least
        i, j, equal = i[keep], j[keep], equal[keep]
    return i, j


def _survivors(table: pa.Table, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of whole units that the comparison leaves, each in the first band that it shares."""
    unit, band, lo, hi, block, size = (table[c].to_numpy() for c in (*_UNIT, "n"))
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(-1, HASHES)
    for i, j in _candidate_pairs(unit, lo, hi, block):
        i, j = bayes_prune(sig, size, i, j, threshold)
        first = (sig[i] == sig[j]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band[i]
        yield i[first], j[first]


_UNIT = ["unit", "band", "lo", "hi", "block"]


def _prune(threshold: float):
    """Rows of a unit that have a partner left; the pairs themselves are found again where their sets are, so none is ever a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _units(batches):
            left = np.zeros(table.num_rows, bool)
            for i, j in _survivors(table, threshold):
                left[i] = left[j] = True
            yield from table.select(["cid", *_UNIT]).filter(pa.array(left)).to_batches()

    return run


def _single_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for table in _units(batches):
        unit = table["unit"].to_numpy()
        edges = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield table.slice(a, b - a)


def _views(sets: pa.Array) -> list[np.ndarray]:
    """The hashes of every binary value, where they lie."""
    _, ends, data = sets.buffers()
    ends = np.frombuffer(ends, np.int32)[sets.offset : sets.offset + len(sets) + 1].tolist()
    return [np.frombuffer(data, np.uint64, (b - a) // 8, a) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _single_units(batches):
            cid, copies = table["cid"].to_numpy(), table["copies"].to_numpy()
            values = _views(table["shingles"].combine_chunks())
            linked, root = [0] * len(cid), list(range(len(cid)))

            def find(k: int, root: list[int] = root) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for i, j in _survivors(table, threshold):
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    x, y = values[a], values[b]
                    common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                    if common >= threshold * (len(x) + len(y) - common):
                        linked[a] += int(copies[b])
                        linked[b] += int(copies[a])
                        root[find(a)] = find(b)
            out = [(int(cid[k]), linked[k], int(cid[find(k)])) for k in range(len(cid)) if linked[k]]
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["cid", "links", "star"])

    return run


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: (doc_id, class_id, n_links, copy_id, n_copies).

    ``class_id`` is the least id of the documents linked directly or through others,
    ``n_links`` the number of documents whose similarity reaches the threshold (copies
    count), ``copy_id`` the least id with the same shingle set, ``n_copies`` their number.
    """
    return _rows(docs, id_col, text_col, threshold).drop("text_hash", "digest", "class_digest")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay when of each class one document does: the one with the least id.

    Rows are told apart by id and text, so that rows of one id (a null one, say) in different
    classes are judged apart; of rows that share the least id the one with the least text hash
    stays, and equal rows of it all do.
    """
    rows = _rows(docs, id_col, text_col, threshold)
    first = rows.filter("class_digest IS NULL OR digest = class_digest").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    alone = first.filter("class_digest IS NULL").select(F.struct("doc_id", "text_hash").alias("stays"))
    least = first.filter("class_digest IS NOT NULL").groupBy("class_digest").agg(F.min(F.struct("doc_id", "text_hash")).alias("stays")).select("stays")
    stays = alone.unionByName(least).distinct()
    same = F.col(id_col).cast("bigint").eqNullSafe(stays["stays"]["doc_id"]) & (_text_hash(text_col) == stays["stays"]["text_hash"])
    return docs.join(stays, same, "left_semi")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _rows(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """The join's rows with the hash of their text, the digest of their shingle set and of their class's first one (null without words)."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), _text_hash(text_col).alias("text_hash"))
    features = scratch_table(texts.mapInArrow(_features, "doc_id bigint, text_hash bigint, n bigint, digest binary, sig binary"), "jaccard-features")
    classes = scratch_table(
        features.filter("n > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "jaccard-classes",
    )

    keys = F.expr(f"transform(sequence(0, {BANDS - 1}), j -> xxhash64(j, substring(sig, j * {2 * ROWS} + 1, {2 * ROWS})))")
    bands = classes.select("cid", F.posexplode(keys).alias("band", "key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("g")).filter("g > 1")
    blocks = F.ceil(F.col("g") / BLOCK).cast("int")
    units = (
        bands.join(shared, "key")
        .withColumn("block", F.pmod(F.xxhash64("cid", "key"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        .select(F.xxhash64("key", "lo", "hi").alias("unit"), "cid", "band", "lo", "hi", "block")
    )
    tasks = shuffle_partitions(docs.sparkSession)
    candidates = units.join(classes.select("cid", "n", "sig"), "cid").repartition(tasks, "unit").sortWithinPartitions("unit")
    pruned = scratch_table(candidates.mapInArrow(_prune(threshold), "cid bigint, unit bigint, band int, lo int, hi int, block int"), "jaccard-left")

    wanted = pruned.select("cid").distinct().join(classes, "cid").select("cid", F.col("copy_id").alias("rep"), "digest")
    sets = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep"))).select("cid", "digest", "text").mapInArrow(_sets, "cid bigint, shingles binary")
    sets = sets.dropDuplicates(["cid"])
    verified = scratch_table(
        pruned.join(sets, "cid")
        .join(classes.select("cid", "copies", "n", "sig"), "cid")
        .repartition(tasks, "unit")
        .sortWithinPartitions("unit")
        .mapInArrow(_verify(threshold), "cid bigint, links bigint, star bigint"),
        "jaccard-links",
    )

    roots = connected(verified, "cid", "star").withColumnRenamed("node", "cid")
    linked = verified.groupBy("cid").agg(F.sum("links").alias("links")).join(roots, "cid")
    named = linked.join(classes.select("cid", "copy_id", "digest"), "cid")
    first = F.min(F.struct(F.col("copy_id").isNull().alias("none"), "copy_id", "digest")).alias("first")
    named = named.join(named.groupBy("root").agg(first), "root").select("cid", "links", F.col("first.copy_id").alias("class_id"), F.col("first.digest").alias("class_digest"))
    info = classes.select("cid", "digest", "copy_id", "copies").join(named, "cid", "left")
    found = features.select("doc_id", "text_hash", "digest", "n").join(info, "digest", "left")
    none = F.col("n") == 0
    single = F.col("class_digest").isNull()  # its set links to no other
    return found.select(
        "doc_id",
        F.when(none, F.col("doc_id")).otherwise(F.when(single, F.col("copy_id")).otherwise(F.col("class_id"))).alias("class_id"),
        F.when(none, F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
        F.when(none, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(none, F.lit(1)).otherwise(F.col("copies")).cast("bigint").alias("n_copies"),
        "text_hash",
        "digest",
        F.when(~none, F.coalesce("class_digest", "digest")).alias("class_digest"),
    )
