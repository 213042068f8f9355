"""Exact dedup over a cuckoo-filter index of live digests.

Every shard (a hash partition of the digests) keeps one index: a cuckoo filter whose
slots point into a table of stored keys.  A filter hit is only a hint; it is verified
against the full stored digest of that slot.  When a row with a larger id arrives, the
live entry is deleted and the new one inserted.  When an insertion overflows, the
filter doubles and is rebuilt from the stored keys.

Defined results: null text counts as empty; a null id is smaller than any id; repeated
rows with one id and one text count each in ``group_size`` and are all ``kept`` if the
id is the largest; texts may have any length; an empty table gives an empty result; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import mix64

SLOTS = 4
#: Sub-groups into which copies of one text are pre-aggregated before they meet in a shard.
SALTS = 16


class CuckooIndex:
    """Digest -> (id, count). Vectorised over batches of distinct 32-byte digests."""

    def __init__(self, buckets: int = 1 << 10, kicks: int = 200):
        self.kicks = kicks
        self.size = 0  # stored rows, dead ones included
        self.digest = np.zeros((1024, 4), np.uint64)
        self.best = np.zeros(1024, np.int64)
        self.count = np.zeros(1024, np.int64)
        self.live = np.zeros(1024, bool)
        self.resizes = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = np.uint64(buckets - 1)
        self.prints = np.zeros((buckets, SLOTS), np.uint16)  # 0: free
        self.rows = np.full((buckets, SLOTS), -1, np.int64)

    def _home(self, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (digest[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (digest[:, 0] & self.mask).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return ((bucket.astype(np.uint64) ^ mix64(prints.astype(np.uint64))) & self.mask).astype(np.int64)

    def lookup(self, digest: np.ndarray) -> np.ndarray:
        """Stored row of each digest, -1 if absent."""
        prints, one = self._home(digest)
        found = np.full(len(digest), -1, np.int64)
        for bucket in (one, self._other(one, prints)):
            for slot in range(SLOTS):
                hit = np.flatnonzero(self.prints[bucket, slot] == prints)
                rows = self.rows[bucket[hit], slot]
                same = (self.digest[rows] == digest[hit]).all(axis=1)  # verified on the whole digest
                found[hit[same]] = rows[same]
        return found

    def _grow_store(self, more: int) -> None:
        need = self.size + more
        if need > len(self.best):
            n = max(need, 2 * len(self.best))
            for name in ("digest", "best", "count", "live"):
                old = getattr(self, name)
                new = np.zeros((n, *old.shape[1:]), old.dtype)
                new[: self.size] = old[: self.size]
                setattr(self, name, new)

    def insert(self, digest: np.ndarray, best: np.ndarray, count: np.ndarray) -> None:
        """Insert distinct digests that the index does not hold."""
        self._grow_store(len(digest))
        rows = np.arange(self.size, self.size + len(digest))
        self.digest[rows], self.best[rows], self.count[rows], self.live[rows] = digest, best, count, True
        self.size += len(digest)
        if not self._place(rows):
            self._resize()

    def delete(self, rows: np.ndarray) -> None:
        """Delete live rows (as given by ``lookup``)."""
        prints, one = self._home(self.digest[rows])
        for bucket in (one, self._other(one, prints)):
            for slot in range(SLOTS):
                mine = self.rows[bucket, slot] == rows
                self.prints[bucket[mine], slot] = 0
                self.rows[bucket[mine], slot] = -1
        self.live[rows] = False

    def _place(self, rows: np.ndarray) -> bool:
        """Put rows into free slots, moving others along; False when the filter overflows."""
        prints, bucket = self._home(self.digest[rows])
        second = self._other(bucket, prints)
        rng = np.random.default_rng(len(rows))
        for kick in range(self.kicks):
            for try_second in (False, True) if kick == 0 else (False,):
                for slot in range(SLOTS):
                    if not len(rows):
                        return True
                    target = second if try_second else bucket
                    free = np.flatnonzero(self.prints[target, slot] == 0)
                    _, first = np.unique(target[free], return_index=True)  # one row per bucket and step
                    put = free[first]
                    self.prints[target[put], slot], self.rows[target[put], slot] = prints[put], rows[put]
                    keep = np.ones(len(rows), bool)
                    keep[put] = False
                    rows, prints, bucket, second = rows[keep], prints[keep], bucket[keep], second[keep]
            if not len(rows):
                return True
            # Evict: one row per bucket takes a slot; the row that was there goes to its other bucket.
            _, put = np.unique(bucket, return_index=True)
            slot = rng.integers(0, SLOTS, len(put))
            b = bucket[put]
            old_prints, old_rows = self.prints[b, slot].copy(), self.rows[b, slot].copy()
            self.prints[b, slot], self.rows[b, slot] = prints[put], rows[put]
            rows[put], prints[put] = old_rows, old_prints
            bucket[put] = self._other(b, old_prints)
        return False

    def _resize(self) -> None:
        """Double the filter and refill it from the stored keys that live."""
        while True:
            self.resizes += 1
            self._empty(2 * (int(self.mask) + 1))
            if self._place(np.flatnonzero(self.live[: self.size])):
                return

    def upsert(self, digest: np.ndarray, best: np.ndarray, count: np.ndarray) -> None:
        """Add partial groups; of equal digests the larger id lives on."""
        at = self.lookup(digest)
        new = at < 0
        self.insert(digest[new], best[new], count[new])
        old, late = at[~new], np.flatnonzero(~new)
        if not len(old):
            return
        total = self.count[old] + count[late]
        wins = best[late] > self.best[old]
        self.count[old] = total
        self.delete(old[wins])
        win = late[wins]
        self.insert(digest[win], best[win], total[wins])

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.flatnonzero(self.live[: self.size])
        return self.digest[rows], self.best[rows], self.count[rows]


#: Stands for a null id inside a shard.
NO_ID = np.iinfo(np.int64).min
_SHARD = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _combine(digest: np.ndarray, best: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per digest of a batch."""
    order = np.lexsort(digest.T)
    digest, best, count = digest[order], best[order], count[order]
    first = np.flatnonzero(np.r_[True, (digest[1:] != digest[:-1]).any(axis=1)])
    return digest[first], np.maximum.reduceat(best, first), np.add.reduceat(count, first)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        if not batch.num_rows:
            continue
        digest = np.frombuffer(b"".join(batch["digest"].to_pylist()), np.uint64).reshape(-1, 4)
        best = batch["best"].fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        index.upsert(*_combine(digest, best, batch["n"].to_numpy(zero_copy_only=False)))
    digest, best, count = index.entries()
    for lo in range(0, len(best), 10_000):
        part = slice(lo, lo + 10_000)
        ids = pa.array(best[part], mask=best[part] == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array([d.tobytes() for d in digest[part]], pa.binary()), ids, pa.array(count[part])], schema=_SHARD)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row; the largest id of equal texts stays.

    Copies are pre-aggregated by (digest, salt) first, so a text that a third of all rows
    share reaches its shard as at most ``SALTS`` rows.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)).alias("digest"),
    )
    partial = rows.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")).agg(
        F.max("doc_id").alias("best"), F.count(F.lit(1)).alias("n")
    )
    groups = partial.select("digest", "best", "n").repartition("digest").mapInArrow(_shard, "digest binary, keep_id bigint, group_size bigint")
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


EXACT_SQL = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g ON t.text_sha256 = g.text_sha256
"""
