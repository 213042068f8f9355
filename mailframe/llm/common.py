"""Shared helpers: Arrow text chunks, word hashes, hand-off tables on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailframe.session import checkpoint_path

#: Bytes of text that a Python worker handles at once; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20
#: Rows in an Arrow batch, so that a batch of long texts fits an executor.
BATCH_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Cap Arrow batches: whole texts travel in them, so the default row count is too many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def scratch_table(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.partitionBy(*([partition] if partition else [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    """Number for repartition() before work that is heavy for its bytes, which adaptive coalescing would put into few tasks."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Split a batch into runs of rows of about ``limit`` bytes; yields (rows, bytes, offsets). Null is empty."""
    texts = batch.column(column)
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    if n == 0:
        return
    _, off_buf, data_buf = texts.buffers()
    offs = np.frombuffer(off_buf, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield batch.slice(lo, hi - lo), data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


#: Odd multiplier of the rolling hash modulo 2^64, and its inverse.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next chunk."""
    have = _POWERS.get(str(base))
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= CHUNK_BYTES + 1:
            _POWERS[str(base)] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser: spread every bit of a uint64 over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span, from prefix sums; equal spans have equal hashes wherever they lie."""
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data)), out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * _powers(BASE_INV, len(data) + 1)[starts]
    return mix64(raw ^ (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def _lower_table(separator) -> np.ndarray:
    """Byte -> lower-cased byte, 0 where it separates words."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    for b in range(256):
        if separator(b):
            table[b] = 0
    return table


#: Words are runs of letters, digits and non-ASCII bytes.
ALNUM_WORDS = _lower_table(lambda b: b < 128 and not chr(b).isalnum())
#: Tokens are runs of anything but space and 0x09-0x0D. A NUL byte is part of a token and keeps the value 1.
SPACE_TOKENS = _lower_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
SPACE_TOKENS[0] = 1


def word_spans(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends, first word of each row and the total); no word crosses a row."""
    low = table[data]
    inside = low != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return low, starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, offs: np.ndarray, table: np.ndarray = ALNUM_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, first word of each row and the total)."""
    low, starts, ends, first = word_spans(data, offs, table)
    return span_hashes(low, starts, ends), first


def segment_ids(first: np.ndarray) -> np.ndarray:
    """Row number of every element, from the first element of each row and the total."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
