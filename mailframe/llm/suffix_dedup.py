"""Removal of long repeats with suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too, in the
same text or another.

1. Every window of LENGTH bytes has an anchor: its least ``GRAM``-byte hash, leftmost of
   equals.  The anchor depends on the window's bytes alone, so equal windows have equal
   anchors at equal places.  Neighbouring windows with one anchor form a run; runs are
   counted by (anchor, content).
2. A content that occurs twice repeats whole.  Contents that share an anchor and differ may
   still share windows; one copy of each goes to a suffix-array shard.
3. A shard is sorted by Larsson-Sadakane refinement and gets its common prefixes by Kasai's
   rule; a window repeats if a neighbour in the suffix array shares LENGTH bytes with it.
   Contents with one anchor are always in one shard; an anchor with more than ``PART``
   contents is dealt into several shards, and each two of those are merged by binary search
   of the one's windows in the other's suffix array.
4. The repeated windows' bytes are cut out of the texts.

Texts are told apart by two 64-bit hashes, contents by the anchor's and their own.

Defined results: null text is empty; texts shorter than LENGTH stay; repeated rows are copies
of each other and go whole; ids may be null or repeated; an empty table gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import BASE, BASE_INV, _powers, bounded_batches, mix64, scratch_table, shuffle_partitions, span_hashes, text_chunks

LENGTH = 400
GRAM = 96
#: Contents of one anchor in a shard.
PART = 2000
#: Bytes of contents that are sorted as one shard.
SHARD_BYTES = 1 << 20
#: Bits of a window key that hold the position in a chunk; the rest hold the gram's hash.
_PLACE_BITS = 27


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: prefix and suffix minima of blocks of that width."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    prefix = np.minimum.accumulate(grid, axis=1).reshape(-1)
    suffix = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(suffix[: n - width + 1], prefix[width - 1 : n])


def runs(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, first window, windows, anchor, content hash) of every run of windows with one anchor."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n), out=prefix[1:])
    hashes = mix64((prefix[gram:] - prefix[:-gram]) * _powers(BASE_INV, n + 1)[: n - gram + 1])
    place = np.arange(len(hashes), dtype=np.uint64)
    least = sliding_min((hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | place, length - gram + 1)
    windows = np.maximum(np.diff(offs) - length + 1, 0)
    row = np.repeat(np.arange(len(windows)), windows)
    at = np.arange(len(row)) + np.repeat(offs[:-1] - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)  # windows within one text
    if not len(at):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    key = least[at]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])])
    count = np.diff(np.r_[first, len(at)])
    start = at[first]
    anchor = hashes[(key[first] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)]
    return row[first], start - offs[row[first]], count, anchor, span_hashes(data, start, start + count + length - 1)


#: Symbols of nine bits that fit a 64-bit word, and the least words that differ in the last one, two, ... of them.
_WORD = 7
_STEPS = np.uint64(1) << np.arange(0, 9 * _WORD, 9, dtype=np.uint64)
#: Bits of the word in which a suffix's group, rank and place are sorted.
_TIE_BITS = 63


def _words(symbols: np.ndarray) -> np.ndarray:
    """The seven symbols from every place on (zeros beyond the end), in one word."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(_WORD, np.uint64)])
    out = np.zeros(n, np.uint64)
    for k in range(_WORD):
        out <<= np.uint64(9)
        out |= padded[k : k + n]
    return out


def _room(symbols: np.ndarray) -> np.ndarray:
    """Symbols from every place to the next separator (0) or the end."""
    place = np.arange(len(symbols))
    end = np.where(symbols == 0, place, len(symbols))
    return np.minimum.accumulate(end[::-1])[::-1] - place


def suffix_array(symbols: np.ndarray, limit: int) -> np.ndarray:
    """Suffixes in the order of their first ``limit`` symbols (0..511) or those up to a separator (0), by Larsson-Sadakane refinement.

    The first sort looks at seven symbols.  Each round doubles that, up to the limit: a group of
    suffixes still equal is split by the rank of the suffix behind what is known; sorted groups and
    those that are equal up to a separator are left alone.  Group, rank and place of a suffix are
    sorted as one word while they fit one.
    """
    n = len(symbols)
    key, room = _words(symbols), _room(symbols)
    order = np.argsort(key, kind="stable")
    key = key[order]
    edge = np.r_[True, key[1:] != key[:-1]]
    rank = np.zeros(n + 1, np.int64)  # of the empty suffix: 0
    rank[order] = np.maximum.accumulate(np.where(edge, np.arange(n), 0)) + 1
    known, bits = _WORD, n.bit_length()
    more = ~(edge & np.r_[edge[1:], True]) & (room[order] >= known)  # places in groups of two or more
    open_, edge = np.flatnonzero(more), edge[more]
    while known < limit and len(open_):
        step = min(known, limit - known)
        suffix = order[open_]
        tie = (np.cumsum(edge) << bits) | rank[suffix + step]
        if 3 * bits <= _TIE_BITS:  # there are half as many groups as places at most
            tie = np.sort((tie << bits) | np.arange(len(open_)))
            again = tie & ((1 << bits) - 1)
            tie >>= bits
        else:
            again = np.argsort(tie, kind="stable")
            tie = tie[again]
        suffix = suffix[again]
        order[open_] = suffix
        edge = np.r_[True, tie[1:] != tie[:-1]]
        rank[suffix] = np.maximum.accumulate(np.where(edge, open_, 0)) + 1
        known += step
        more = ~(edge & np.r_[edge[1:], True]) & (room[suffix] >= known)
        open_, edge = open_[more], edge[more]
    return order


def common_prefixes(symbols: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each suffix with ``limit`` symbols before a separator those it shares with the one before it in the order, up to ``limit``; 0 for others.

    By Kasai's rule a suffix shares one symbol less than the suffix one place to the left, if that
    one's neighbour is also one place to the left; only the others are compared, a word at a time and
    as far as they agree, so that the rule counts down from the true length.
    """
    n = len(symbols)
    room = _room(symbols)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[:1]] = -1
    place = np.arange(n)
    fresh = np.ones(n, bool)
    fresh[1:] = (before[:-1] < 0) | (before[1:] != before[:-1] + 1) | (room[:-1] == 0) | (symbols[:-1] != symbols[np.maximum(before[:-1], 0)])
    words = _words(symbols)
    shared = np.zeros(n, np.int64)
    todo, done = np.flatnonzero(fresh & (room >= limit) & (before >= 0)), 0
    left, right = todo, before[todo]
    end = np.minimum(room[left], room[right])  # the shorter suffix ends here
    while len(todo):
        differ = words[left + done] ^ words[right + done]
        shared[todo] = np.minimum(done + _WORD - np.searchsorted(_STEPS, differ, "right"), end)
        done += _WORD
        on = (differ == 0) & (done < end)
        todo, left, right, end = todo[on], left[on], right[on], end[on]
    last = np.maximum.accumulate(np.where(fresh, place, 0))
    return np.where(room >= limit, np.clip(shared[last] - (place - last), 0, limit), 0)


class Shard:
    """Suffix array over contents, parted by a symbol that no byte has."""

    def __init__(self, contents: list[bytes], length: int = LENGTH):
        self.length = length
        self.sizes = np.array([len(c) for c in contents])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + 1)])[:-1]
        raw = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
        self.raw = raw
        self.symbols = raw.astype(np.uint16) + np.uint16(1)
        self.symbols[self.starts + self.sizes] = 0
        # Bytes up to the content's end.
        self.room = np.repeat(self.sizes, self.sizes + 1) - (np.arange(len(raw)) - np.repeat(self.starts, self.sizes + 1))
        self.order = suffix_array(self.symbols, length)

    def repeated(self) -> np.ndarray:
        """For every place: whether the window there occurs twice in the shard."""
        shared = common_prefixes(self.symbols, self.order, self.length)
        full = self.room >= self.length
        hit = (shared >= self.length) & full
        out = np.zeros(len(self.symbols), bool)
        at = np.flatnonzero(hit[self.order])
        out[self.order[at]] = True
        out[self.order[at - 1]] = True
        return out & full

    def windows(self, places: np.ndarray) -> np.ndarray:
        """Windows as big-endian words, in byte order."""
        view = np.lib.stride_tricks.sliding_window_view(np.concatenate([self.raw, np.zeros(8, np.uint8)]), -(-self.length // 8) * 8)
        words = np.ascontiguousarray(view[places])
        words[:, self.length :] = 0
        return words.view(">u8").astype(np.uint64)

    def found_in(self, other: Shard) -> np.ndarray:
        """For every place: whether the window there occurs in the other shard, by binary search in its suffix array."""
        out = np.zeros(len(self.symbols), bool)
        sorted_ = other.order[other.room[other.order] >= other.length]
        places = np.flatnonzero(self.room >= self.length)
        if not len(sorted_):
            return out
        for lo in range(0, len(places), 10_000):
            part = places[lo : lo + 10_000]
            mine = self.windows(part)
            left, right = np.zeros(len(part), np.int64), np.full(len(part), len(sorted_))
            while (open_ := np.flatnonzero(left < right)).size:
                middle = (left[open_] + right[open_]) // 2
                theirs, own = other.windows(sorted_[middle]), mine[open_]
                differ = theirs != own
                column = differ.argmax(axis=1)
                k = np.arange(len(open_))
                less = differ[k, column] & (theirs[k, column] < own[k, column])
                left[open_[less]] = middle[less] + 1
                right[open_[~less]] = middle[~less]
            ok = left < len(sorted_)
            out[part[ok]] = (other.windows(sorted_[left[ok]]) == mine[ok]).all(axis=1)
        return out


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _find_runs(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in text_chunks(batch):
                row, first, count, anchor, content = runs(data, offs, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["k1"].take(pa.array(row)),
                        part["k2"].take(pa.array(row)),
                        pa.array(first),
                        pa.array(count),
                        pa.array(anchor.view(np.int64)),
                        pa.array(content.view(np.int64)),
                    ],
                    names=["k1", "k2", "first", "windows", "anchor", "content"],
                )

    return run


def _cut_contents(length: int):
    """Bytes of the wanted runs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            size = 0
            for text, wanted in zip(batch["text"], batch["wanted"].to_pylist(), strict=True):
                raw = (text.as_py() or "").encode()
                for w in wanted:
                    piece = raw[w["first"] : w["first"] + w["windows"] + length - 1]
                    out.append((w["anchor"], w["content"], piece))
                    size += len(piece)
                if size > 4 << 20:
                    yield _contents(out)
                    out, size = [], 0
            yield _contents(out)

    return run


def _contents(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    anchor, content, piece = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(content, pa.int64()), pa.array(piece, pa.binary())], names=["anchor", "content", "piece"])


def _search_units(length: int):
    """Windows of contents that occur in another content: rows sorted by unit come as whole units, several to a shard."""

    def search(rows: list[dict]) -> list[tuple[int, int, int, int]]:
        merged = [r for r in rows if r["lo"] != r["hi"]]
        alone = [r for r in rows if r["lo"] == r["hi"]]
        hits: list[tuple[dict, np.ndarray]] = []
        if alone:
            shard = Shard([r["piece"] for r in alone], length)
            found = shard.repeated()
            hits += [(r, found[a : a + n]) for r, a, n in zip(alone, shard.starts, shard.sizes, strict=True)]
        by_unit: dict[int, list[dict]] = {}
        for r in merged:
            by_unit.setdefault(r["unit"], []).append(r)
        for group in by_unit.values():
            one = [r for r in group if r["part"] == r["lo"]]
            two = [r for r in group if r["part"] == r["hi"]]
            if not one or not two:
                continue
            a, b = Shard([r["piece"] for r in one], length), Shard([r["piece"] for r in two], length)
            for shard, other, members in ((a, b, one), (b, a, two)):
                found = shard.found_in(other)
                hits += [(r, found[s : s + n]) for r, s, n in zip(members, shard.starts, shard.sizes, strict=True)]
        return [(r["anchor"], r["content"], s, e) for r, found in hits for s, e in _spans(found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size = 0

        def emit(rows: list[dict]) -> pa.RecordBatch:
            out = search(rows)
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["anchor", "content", "start", "end"])

        for batch in batches:
            for r in batch.to_pylist():
                if size > SHARD_BYTES and r["unit"] != rows[-1]["unit"]:
                    yield emit(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r["piece"])
        if rows:
            yield emit(rows)

    return run


def _remove(length: int):
    """Cut the union of the spans out of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for text, cuts in zip(batch["text"], batch["cuts"], strict=True):
                raw = (text.as_py() or "").encode()
                out, at, gone, n = [], 0, 0, 0
                if cuts.is_valid:
                    ends = sorted((c["a"], c["b"]) for c in cuts.as_py())
                    merged: list[list[int]] = []
                    for a, b in ends:
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    for a, b in merged:
                        out.append(raw[at:a])
                        at, gone, n = b, gone + b - a, n + 1
                out.append(raw[at:])
                sizes.append(len(raw))
                removed.append(gone)
                spans.append(n)
                kept.append(b"".join(out))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, part: int = PART, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` holds the remaining bytes."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).withColumns(
        {"k1": F.xxhash64(F.lit(1), F.col("text")), "k2": F.xxhash64(F.lit(2), F.col("text"))}
    )
    found = scratch_table(
        texts.filter(F.octet_length("text") >= length)
        .select("k1", "k2", "text")
        .mapInArrow(_find_runs(length, gram), "k1 bigint, k2 bigint, first bigint, windows bigint, anchor bigint, content bigint"),
        "suffix-runs",
    )
    classes = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), (F.min("content") != F.max("content")).alias("mixed")).filter("n > 1")
    classes = scratch_table(classes.select("anchor", "mixed"), "suffix-classes")  # both sides of the join are then read, and a hot anchor can be split
    shared = scratch_table(found.join(classes, "anchor"), "suffix-shared")

    contents = scratch_table(
        shared.filter("mixed")
        .groupBy("anchor", "content")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "first", "windows")).alias("rep")),
        "suffix-contents",
    )
    wanted = contents.groupBy("rep.k1", "rep.k2").agg(
        F.collect_list(F.struct(F.col("rep.first").alias("first"), F.col("rep.windows").alias("windows"), "anchor", "content")).alias("wanted")
    )
    pieces = texts.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("text", "wanted")
    pieces = pieces.mapInArrow(_cut_contents(length), "anchor bigint, content bigint, piece binary").dropDuplicates(["anchor", "content"])

    # Only anchors with several shards are joined, so that the contents of a hot one are not gathered for their count.
    large = contents.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts")).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    units = (
        pieces.join(scratch_table(large, "suffix-large"), "anchor", "left")
        .withColumn("part", F.pmod(F.xxhash64("content"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")})
        .select(F.xxhash64("anchor", "lo", "hi").alias("unit"), "lo", "hi", "part", "anchor", "content", "piece")
    )
    again = units.repartition(shuffle_partitions(docs.sparkSession), "unit").sortWithinPartitions("unit").mapInArrow(_search_units(length), "anchor bigint, content bigint, start bigint, end bigint")
    again = scratch_table(again.groupBy("anchor", "content").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "suffix-again")

    # A content that occurs once has one place, its own; all other runs go whole.
    once = contents.filter("n = 1").select("anchor", "content", "rep")
    whole = shared.join(once, ["anchor", "content"], "left_anti").select(
        "k1", "k2", F.col("first").alias("a"), (F.col("first") + F.col("windows") + length - 1).alias("b")
    )
    partly = (
        once.join(again, ["anchor", "content"])
        .select("rep", F.explode("spans").alias("s"))
        .select(
            F.col("rep.k1").alias("k1"),
            F.col("rep.k2").alias("k2"),
            (F.col("rep.first") + F.col("s.start")).alias("a"),
            (F.col("rep.first") + F.col("s.end") + length - 1).alias("b"),
        )
    )
    cuts = whole.unionByName(partly).groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "b")).alias("cuts"))
    return (
        texts.join(cuts, ["k1", "k2"], "left")
        .select("doc_id", "text", "cuts")
        .mapInArrow(_remove(length), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    )
