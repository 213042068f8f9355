"""Language-model scoring by context-tree weighting over bytes.

Every byte is eight binary decisions.  A decision is made in the context of the bits of its
byte so far and of up to ``DEPTH`` bytes before it.  Each node (context, bits so far) holds
how often a 0 and a 1 followed in the training texts and a Krichevsky-Trofimov estimate from
them; the weighting mixes the estimates of all depths on the path: a node stops with weight
P_kt / (2 P_w), where P_w is half its own estimate's probability of its data plus half the
product over its child contexts.  A path ends at the deepest node that training data reached.
The sum of the logarithms is the code length of the text.  Every context that training texts
hold is a node; none is merged or left out, whatever the input's size.

Texts are dealt to blocks of about ``BLOCK_BYTES``.  A block is counted into its distinct byte
(DEPTH + 1)-grams and tokens, packed by bucket: the grams whose last two context bytes agree
share a bucket, so a bucket holds whole subtrees from depth two on.  Buckets are merged to
counts and, in a second pass, answer every block's distinct grams with their code lengths and
its tokens with their counts; a block's answers meet its texts by a join on the block.  Only
the two upper levels (at most 255 x 256 nodes of depth one) pass through the driver.  A task holds
one bucket's distinct grams, and there are as many buckets as the input has ``BUCKET_BYTES``, up
to one for every two bytes; or one block and its answers.

Tokens are told apart by a 64-bit hash.

Defined results: null text is empty: one end token and one end byte; without training texts
every bit costs one bit; repeated rows get equal scores; a text may have any length and is
scored whole, one beyond ``BLOCK_BYTES`` in a block of its own (about 40 times its bytes in the task);
an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, LongType, StructField, StructType

from mailframe.llm.common import SPACE_TOKENS, bounded_batches, mix64, scratch_table, shuffle_partitions, text_chunks, word_hashes

DEPTH = 5
#: Context bytes that a bucket's grams share; the levels above are computed from all buckets.
SHARED = 2
#: Text that is counted, and answered, together.
BLOCK_BYTES = 16 << 20
#: Text for which there is a bucket.
BUCKET_BYTES = 1 << 20
#: Text for which there is a shuffle partition, where the session has fewer.
TASK_BYTES = 32 << 20
#: Keys in one packed row.
ROW_KEYS = 8192
END = 0  # byte behind every text, and before it as context
#: Key of the end token; words hash to anything else.
END_TOKEN = 0
GRAM, TOKEN, ABOVE = 0, 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(data: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context, byte) of every byte of every text and its end, the byte lowest; and where each text begins."""
    n = len(offs) - 1
    size = np.diff(offs) + depth + 1
    start = np.concatenate([[0], np.cumsum(size)])
    padded = np.full(start[-1], END, np.uint64)
    at = np.arange(len(data)) + np.repeat(start[:-1] + depth - offs[:-1], np.diff(offs))
    padded[at] = _LOWER[data]
    packed = np.zeros(max(len(padded) - depth, 0), np.uint64)
    for k in range(depth + 1):
        packed = (packed << np.uint64(8)) | padded[k : k + len(packed)]
    # A gram that ends in the padding before a text is none of its bytes.
    real = np.ones(len(padded), bool)
    for k in range(depth):
        real[start[:-1] + k] = False
    first = offs + np.arange(n + 1)
    return packed[real[depth:]], first


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key of every word, first word of each text and the total)."""
    words, first = word_hashes(data, offs, SPACE_TOKENS)
    words[words == END_TOKEN] = 1
    return words, first


def _grouped(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct sorted keys and the sums of the values."""
    if not len(key):
        return key, *values
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    return key[order][first], *(np.add.reduceat(v[order], first) for v in values)


class Counts:
    """Sums by key, folded whenever much has been added."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.folded = 0

    def add(self, key: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((key, n))
        self.size += len(key)
        if self.size > 2 * self.folded + 2_000_000:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys and their sums."""
        if len(self.parts) != 1:
            key = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in self.parts)])
            n = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in self.parts)])
            self.parts = [_grouped(key, n)]
            self.size = self.folded = len(self.parts[0][0])
        return self.parts[0]


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series, eight steps up."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


@dataclass
class Level:
    """Nodes of one context depth: sorted keys (context, bits so far), estimate of a 1, weight of stopping here."""

    keys: np.ndarray
    one: np.ndarray
    stop: np.ndarray

    def mix(self, key: np.ndarray, chance: np.ndarray, reached: np.ndarray) -> None:
        """Weigh the estimates against what deeper levels say; the deepest node reached has no other say."""
        if not len(self.keys):
            return
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rows = np.flatnonzero(self.keys[at] == key)
        at = at[rows]
        stop = np.where(reached[rows], self.stop[at], 1.0)
        chance[rows] = stop * self.one[at] + (1 - stop) * chance[rows]
        reached[rows] = True


def _level(key: np.ndarray, zero: np.ndarray, one: np.ndarray, stop: np.ndarray) -> Level:
    return Level(key, ((one + 0.5) / (zero + one + 1.0)).astype(np.float32), stop.astype(np.float32))


def _inner(key: np.ndarray, zero: np.ndarray, one: np.ndarray, below: np.ndarray) -> tuple[Level, np.ndarray]:
    """(level, ln of the weighted probability) of nodes with children, whose own are ``below`` together."""
    mine = log_kt(zero, one)
    whole = np.logaddexp(mine, below) + np.log(0.5)
    return _level(key, zero, one, np.exp(np.log(0.5) + mine - whole)), whole


def _upto(depth: int) -> np.uint64:
    """Mask of a node key of that depth: its newest context bytes and the bits so far."""
    return np.uint64((1 << 8 * (depth + 1)) - 1)


def _decision(gram: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and bits so far, whether the next bit is 1) of the ``bit``-th decision of each gram's byte."""
    byte = gram & np.uint64(255)
    sofar = (np.uint64(1) << np.uint64(bit)) | (byte >> np.uint64(8 - bit))
    return (gram & ~np.uint64(255)) | sofar, ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)


class Subtrees:
    """Weighted nodes of depth ``SHARED`` and more over counted grams. Decisions of different place in a byte share no node, so each place has its own levels."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, depth: int):
        """``gram``: sorted, distinct, with all grams of the same last ``SHARED`` context bytes."""
        self.depth = depth
        self.levels: list[list[Level]] = []  # by place of the bit, deepest first
        above = []
        for bit in range(8):
            node, is_one = _decision(gram, bit)
            key, zero, one = _grouped(node, np.where(is_one, 0.0, n), np.where(is_one, n, 0.0))
            whole = log_kt(zero, one)
            levels = [_level(key, zero, one, np.ones(len(key)))]
            for d in range(depth - 1, SHARED - 1, -1):
                key, zero, one, below = _grouped(key & _upto(d), zero, one, whole)
                level, whole = _inner(key, zero, one, below)
                levels.append(level)
            self.levels.append(levels)
            above.append(_grouped(key & _upto(SHARED - 1), zero, one, whole))
        #: What the nodes one level up get from here: key, zeros, ones, ln of their children's probability.
        self.above = tuple(np.concatenate(column) for column in zip(*above, strict=True))

    def code_length(self, gram: np.ndarray, upper: list[Level]) -> np.ndarray:
        """Bits that each gram's byte costs in its context."""
        total = np.zeros(len(gram))
        for bit in range(8):
            node, is_one = _decision(gram, bit)
            chance = np.full(len(gram), 0.5)
            reached = np.zeros(len(gram), bool)
            for d, level in zip(range(self.depth, -1, -1), [*self.levels[bit], *upper], strict=True):
                level.mix(node & _upto(d), chance, reached)
            total -= np.log2(np.where(is_one, chance, 1 - chance))
        return total


def upper_levels(key: np.ndarray, zero: np.ndarray, one: np.ndarray, below: np.ndarray) -> list[Level]:
    """Levels above the subtrees, deepest first, from what all subtrees hand up."""
    out = []
    for d in range(SHARED - 1, -1, -1):
        key, zero, one, below = _grouped(key & _upto(d), zero, one, below)
        level, below = _inner(key, zero, one, below)
        out.append(level)
    return out


class CodeTable:
    """Open-addressing table of distinct keys -> code length."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray, bits: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(2 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.key, self.bits = np.full(size, self.EMPTY), np.zeros(size, np.float32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            _, first = np.unique(slot, return_index=True)
            put = first[self.key[slot[first]] == self.EMPTY]
            self.key[slot[put]], self.bits[slot[put]] = keys[left[put]], bits[left[put]]
            keep = np.ones(len(left), bool)
            keep[put] = False
            left, slot = left[keep], (slot[keep] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) >> self.shift).astype(np.int64)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Code lengths of keys that the table holds."""
        slot = self._slot(keys)
        out = self.bits[slot]
        left = np.flatnonzero(self.key[slot] != keys)
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.key) - 1)
            hit = self.key[slot] == keys[left]
            out[left[hit]] = self.bits[slot[hit]]
            left, slot = left[~hit], slot[~hit]
        return out


def _runs(column: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(value, from, to) of runs of equal values."""
    values = column.to_numpy(zero_copy_only=False)
    edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else np.zeros(1, int)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(values[lo]), lo, hi


def _pack(values: np.ndarray) -> bytes:
    """An array as its length and its compressed byte planes; keys as differences, which ascending keys keep small."""
    if values.dtype == np.uint64:
        values = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return len(values).to_bytes(4, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(row: pa.Scalar, dtype: type) -> np.ndarray:
    value, size = row.as_py(), np.dtype(dtype).itemsize
    n = int.from_bytes(value[:4], "little")
    planes = np.frombuffer(pa.decompress(value[4:], n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    values = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return np.cumsum(values, dtype=np.uint64) if dtype is np.uint64 else values


def in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, learn, text) as a written table of chunks: the ids, marks and lengths of a run of texts, their bytes, and the chunk's block."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part, data, offs in text_chunks(batch):
                if filled and filled + offs[-1] > BLOCK_BYTES:
                    block, filled = block + 1, 0
                filled += int(offs[-1]) + 1
                whole = pa.array([0, part.num_rows], pa.int32())
                columns = [
                    pa.array([block]),
                    pa.array([int(offs[-1])]),
                    pa.ListArray.from_arrays(whole, part.column("doc_id")),
                    pa.ListArray.from_arrays(whole, part.column("learn")),
                    pa.array([_pack(np.diff(offs))], pa.binary()),
                    pa.array([_pack(data)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["block", "size", "ids", "learn", "lengths", "data"])

    ids = StructField("ids", ArrayType(rows.schema["doc_id"].dataType))
    rest = [StructField("learn", ArrayType(BooleanType())), StructField("lengths", BinaryType()), StructField("data", BinaryType())]
    schema = StructType([StructField("block", LongType()), StructField("size", LongType()), ids, *rest])
    return scratch_table(rows.mapInArrow(deal, schema), "ctw-texts")


def _text_bytes(lengths: pa.Scalar, data: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a chunk's texts."""
    return _unpack(data, np.uint8), np.concatenate([[0], np.cumsum(_unpack(lengths, np.int64))])


def _bucket(kind: int, key: np.ndarray, buckets: int) -> np.ndarray:
    shared = (key >> np.uint64(8)) & np.uint64((1 << 8 * SHARED) - 1) if kind == GRAM else key
    return (mix64(shared) % np.uint64(buckets)).astype(np.int32)


COUNTED = "kind tinyint, bucket int, block bigint, keys binary, counts binary"


def count(texts: DataFrame, depth: int, buckets: int) -> DataFrame:
    """Every block's distinct grams and tokens with their number in its training texts, packed by bucket."""

    def packed(block: int, counts: dict[int, Counts]) -> Iterator[pa.RecordBatch]:
        for kind, counted in counts.items():
            key, n = counted.total()
            bucket = _bucket(kind, key, buckets)
            order = np.argsort(bucket, kind="stable")
            key, n = key[order], n[order].astype(np.int64)
            rows = [(b, lo + at, min(lo + at + ROW_KEYS, hi)) for b, lo, hi in _runs(pa.array(bucket[order])) for at in range(0, hi - lo, ROW_KEYS)]
            for at in range(0, len(rows), 500):
                some = rows[at : at + 500]
                columns = [
                    pa.array([kind] * len(some), pa.int8()),
                    pa.array([b for b, _, _ in some], pa.int32()),
                    pa.array([block] * len(some), pa.int64()),
                    pa.array([_pack(key[lo:hi]) for _, lo, hi in some], pa.binary()),
                    pa.array([_pack(n[lo:hi]) for _, lo, hi in some], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "bucket", "block", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, {}
        for batch in batches:
            for i, block in enumerate(batch["block"].to_pylist()):
                if block != now:
                    if now is not None:
                        yield from packed(now, counts)
                    now, counts = block, {GRAM: Counts(), TOKEN: Counts()}
                data, offs = _text_bytes(batch["lengths"][i], batch["data"][i])
                learn = batch["learn"][i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                gram, first = grams(data, offs, depth)
                marked, n = np.unique((gram << np.uint64(1)) | np.repeat(learn, np.diff(first)).astype(np.uint64), return_counts=True)
                counts[GRAM].add(*_grouped(marked >> np.uint64(1), np.where(marked & np.uint64(1), n, 0)))
                key, first = tokens(data, offs)
                ends = np.full(len(learn), END_TOKEN, np.uint64)
                counts[TOKEN].add(*_grouped(np.r_[key, ends], np.r_[np.repeat(learn, np.diff(first)), learn]))
        if now is not None:
            yield from packed(now, counts)

    return scratch_table(texts.select("block", "learn", "lengths", "data").mapInArrow(run, COUNTED), "ctw-counted")




def _row(kind: int, bucket: int, key: np.ndarray, zero: np.ndarray, one: np.ndarray, below: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([kind], pa.int8()), pa.array([bucket], pa.int32()), *(pa.array([_pack(x)], pa.binary()) for x in (key, one, zero, below))]
    columns += [pa.array([int(one.sum())]), pa.array([len(key)])]
    return pa.RecordBatch.from_arrays(columns, ["kind", "bucket", "keys", "counts", "zeros", "below", "n", "v"])


def merge(counted: DataFrame, depth: int, tasks: int) -> DataFrame:
    """Buckets with the sums over all blocks, keys without a training count left out; and what their subtrees hand up."""
    none = np.zeros(0)

    def closed(kind: int, bucket: int, counts: Counts) -> Iterator[pa.RecordBatch]:
        key, n = counts.total()
        key, n = key[n > 0], n[n > 0]
        for lo in range(0, len(key), ROW_KEYS):
            yield _row(kind, bucket, key[lo : lo + ROW_KEYS], none, n[lo : lo + ROW_KEYS], none)
        if kind == GRAM and len(key):
            up, zero, one, below = Subtrees(key, n, depth).above
            yield _row(ABOVE, bucket, up, zero, one, below)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, Counts()
        for batch in batches:
            for i in range(batch.num_rows):
                at = (batch["kind"][i].as_py(), batch["bucket"][i].as_py())
                if at != now:
                    if now is not None:
                        yield from closed(*now, counts)
                    now, counts = at, Counts()
                counts.add(_unpack(batch["keys"][i], np.uint64), _unpack(batch["counts"][i], np.int64))
        if now is not None:
            yield from closed(*now, counts)

    rows = counted.select("kind", "bucket", "keys", "counts").repartition(tasks, "kind", "bucket").sortWithinPartitions("kind", "bucket")
    schema = "kind tinyint, bucket int, keys binary, counts binary, zeros binary, below binary, n bigint, v bigint"
    return scratch_table(rows.mapInArrow(run, schema), "ctw-merged")


def _upper(merged: DataFrame) -> list[Level]:
    """Levels above the subtrees; the sums over all buckets are 255 x 256 rows at most."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key = _unpack(batch["keys"][i], np.uint64).view(np.int64)
                sums = [_unpack(batch[c][i], np.float64) for c in ("zeros", "counts", "below")]
                yield pa.RecordBatch.from_arrays([pa.array(key), *map(pa.array, sums)], ["key", "zero", "one", "below"])

    rows = merged.filter(F.col("kind") == ABOVE).select("keys", "zeros", "counts", "below")
    each = rows.mapInArrow(unpack, "key bigint, zero double, one double, below double")
    table = each.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("zero", "one", "below"))).toArrow()
    return upper_levels(table["key"].to_numpy().view(np.uint64), *(table[c].to_numpy() for c in ("zero", "one", "below")))


def answer(counted: DataFrame, merged: DataFrame, upper: list[Level], depth: int, tasks: int) -> DataFrame:
    """(block, kind, keys, found): code lengths of every block's grams, training counts of its tokens."""
    shared = counted.sparkSession.sparkContext.broadcast(upper)

    class Bucket:
        """A bucket's counts, closed when the first block asks."""

        def __init__(self, kind: int):
            self.kind, self.counts, self.key = kind, Counts(), None

        def found(self, keys: np.ndarray) -> np.ndarray:
            if self.key is None:
                self.key, n = self.counts.total()
                self.value = n
                if self.kind == GRAM:
                    self.tree = Subtrees(self.key, n, depth)
                    self.value = self.tree.code_length(self.key, shared.value)
            at = np.searchsorted(self.key, keys)
            known = np.zeros(len(keys), bool) if not len(self.key) else self.key[np.minimum(at, len(self.key) - 1)] == keys
            out = np.zeros(len(keys))
            out[known] = self.value[at[known]]
            if self.kind == GRAM and not known.all():
                new, which = np.unique(keys[~known], return_inverse=True)
                out[~known] = self.tree.code_length(new, shared.value)[which]
            return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bucket = None, None
        for batch in batches:
            place = pa.array(batch["bucket"].to_numpy().astype(np.int64) * 4 + batch["kind"].to_numpy())
            for at, lo, hi in _runs(place):
                if at != now:
                    now, bucket = at, Bucket(at & 3)
                blocks = batch["block"].to_numpy()[lo:hi]
                keys = [_unpack(batch["keys"][i], np.uint64) for i in range(lo, hi)]
                asked = int(np.searchsorted(blocks, 0))  # the bucket's own rows come first, as block -1
                for i in range(asked):
                    bucket.counts.add(keys[i], _unpack(batch["counts"][lo + i], np.int64))
                if asked == hi - lo:
                    continue
                found = bucket.found(np.concatenate(keys[asked:])).astype(np.float32 if bucket.kind == GRAM else np.float64)
                cuts = np.cumsum([0, *map(len, keys[asked:])])
                columns = [
                    pa.array(blocks[asked:]),
                    pa.array([bucket.kind] * (hi - lo - asked), pa.int8()),
                    batch["keys"].slice(lo + asked, hi - lo - asked),
                    pa.array([_pack(found[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["block", "kind", "keys", "found"])

    model = merged.filter(F.col("kind") != ABOVE).select("kind", "bucket", F.lit(-1).cast("bigint").alias("block"), "keys", "counts")
    asked = counted.select("kind", "bucket", "block", "keys", F.lit(None).cast("binary").alias("counts"))
    rows = model.unionByName(asked).repartition(tasks, "kind", "bucket").sortWithinPartitions("kind", "bucket", "block")
    return rows.mapInArrow(run, "block bigint, kind tinyint, keys binary, found binary")


SCORES = ["n_tokens", "n_known", "base_score", "score", "bits_per_byte"]


def _found(table: pa.Table, kind: int, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of that kind among a block's answers, and what was found for them."""
    rows = [i for i, k in enumerate(table["kind"].to_pylist()) if k == kind]
    key = np.concatenate([_unpack(table["keys"][i], np.uint64) for i in rows])
    key, at = np.unique(key, return_index=True)
    return key, np.concatenate([_unpack(table["found"][i], dtype) for i in rows])[at]


def score_documents(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row; learns from the rows where ``training`` holds."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(training, F.lit(False)).alias("learn"), F.col(text_col).alias("text"))
    texts = in_blocks(rows)
    size = texts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(16, min(size // BUCKET_BYTES, 1 << 8 * SHARED))
    tasks = max(shuffle_partitions(docs.sparkSession), size // TASK_BYTES)
    counted = count(texts, depth, buckets)
    merged = merge(counted, depth, tasks)
    n_all, v_all = merged.filter(F.col("kind") == TOKEN).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    answers = answer(counted, merged, _upper(merged), depth, tasks)

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        table = CodeTable(*_found(found, GRAM, np.float32))
        word, times = _found(found, TOKEN, np.float64)
        cost = np.log10((times + 0.1) / (n_all + 0.1 * (v_all + 1)))
        parts: list[list[np.ndarray]] = [[] for _ in range(5)]
        ids = []
        for i in range(block.num_rows):
            data, offs = _text_bytes(block["lengths"][i], block["data"][i])
            gram, first = grams(data, offs, depth)
            total = np.add.reduceat(table.lookup(gram).astype(np.float64), first[:-1])
            key, start = tokens(data, offs)
            number = np.diff(start) + 1
            at, end = np.searchsorted(word, key), int(np.searchsorted(word, np.uint64(END_TOKEN)))
            row = np.repeat(np.arange(len(number)), number - 1)
            known = np.bincount(row, times[at] > 0, len(number)) + (times[end] > 0)
            base = np.bincount(row, cost[at], len(number)) + cost[end]
            ids.append(block["ids"][i].values)
            for column, value in zip(parts, (number, known.astype(np.int64), base, -total * np.log10(2), total / (np.diff(offs) + 1)), strict=True):
                column.append(value)
        return pa.table([pa.chunked_array(ids, block.schema.field("ids").type.value_type), *(pa.array(np.concatenate(c)) for c in parts)], ["doc_id", *SCORES])

    schema = StructType([rows.schema["doc_id"], *(StructField(c, LongType() if c in SCORES[:2] else DoubleType()) for c in SCORES)])
    asking = texts.select("block", "ids", "lengths", "data").repartition(tasks, "block").groupBy("block")
    met = asking.cogroup(answers.repartition(tasks, "block").groupBy("block"))
    return met.applyInArrow(run, schema).withColumn("train_tokens", F.lit(int(n_all)).cast("bigint"))
