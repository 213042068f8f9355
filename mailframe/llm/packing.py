"""Sum-of-squares online packing of token sequences into windows.

Each input partition packs its own documents online.  A document of L tokens fills
L // window whole windows; the rest, of r tokens, goes into the fill level h for which
the sum of squared counts of partially filled windows grows least.  The level array
holds those counts.  When a partition ends, the windows still open are joined by
cutting pieces, and what is left is cut into windows of a power of two tokens, which
need no padding.  With a group column (a language, say) a partition packs each group by
itself, so that no window mixes groups.

Defined results: null text is empty and holds only the end id; null or repeated ids
are packed like any other row; repeated rows are packed each; texts may have any length; an
empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import bounded_batches

WINDOW = 1024
END_ID = 0


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary: itself if printable, else 256 and up in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_encoder(path: str):
    """The byte-level BPE of a ``tokenizers`` JSON file, run by tiktoken: same ids, several times as fast.

    Its merges make ids in rank order, which is what tiktoken needs; added tokens are matched as in the file.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    encoding = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode(text, allowed_special="all")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


class SquareSumPacker:
    """Online packer; ``place`` gives the pieces of windows that closed: (doc, start, ids, doc tokens, window, offset)."""

    def __init__(self, window: int = WINDOW, new_ids: Iterator[int] | None = None):
        self.window = window
        self.new_ids = itertools.count() if new_ids is None else new_ids
        self.levels = np.zeros(window + 1, np.int64)  # open windows by fill
        self.open: list[list[list]] = [[] for _ in range(window)]

    def level_for(self, size: int) -> int:
        """Fill level that takes ``size`` tokens with the least growth of the sum of squares; the fullest of equals."""
        counts, top = self.levels, self.window - size
        growth = 2 * (counts[size : self.window + 1] - counts[: top + 1] + 1)
        growth[0] = 2 * counts[size] + 1  # a new window
        growth[top] = 1 - 2 * counts[top]  # a window that closes
        growth[1:][counts[1 : top + 1] == 0] = np.iinfo(np.int64).max
        return int(top - np.argmin(growth[::-1]))

    def place(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        total, size = len(ids), self.window
        whole = total - total % size
        for start in range(0, whole, size):
            yield doc, start, ids[start : start + size], total, next(self.new_ids), 0
        rest = ids[whole:]
        if not len(rest):
            return
        level = self.level_for(len(rest))
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
        pieces.append((doc, whole, rest, total))
        fill = level + len(rest)
        if fill == size:
            yield from self._close(pieces)
        else:
            self.open[fill].append(pieces)
            self.levels[fill] += 1

    def _close(self, pieces: list) -> Iterator[tuple]:
        window, offset = next(self.new_ids), 0
        for doc, start, ids, total in pieces:
            yield doc, start, ids, total, window, offset
            offset += len(ids)

    def finish(self) -> Iterator[tuple]:
        """Join the open windows by cutting; the last tokens fill windows of a power of two."""
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        left = sum(len(p[2]) for p in pieces)
        at = used = 0
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            part, room = [], size
            while room:
                doc, start, ids, total = pieces[at]
                take = min(room, len(ids) - used)
                part.append((doc, start + used, ids[used : used + take], total))
                room, used = room - take, used + take
                if used == len(ids):
                    at, used = at + 1, 0
            yield from self._close(part)
            left -= size


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
         group_col: str | None = None) -> DataFrame:
    """One row per piece; ``ids`` holds its token ids as little-endian unsigned 32-bit numbers.

    Nothing is shuffled: a window never mixes input partitions, nor values of ``group_col``, if given
    (null is one of them), and each group of a partition leaves less than ``window`` tokens in small windows.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(path)
        new_ids = itertools.count(TaskContext.get().partitionId() << 40)
        packers: dict[str | None, SquareSumPacker] = {}

        def rows(pieces: list) -> pa.RecordBatch:
            doc, start, ids, total, seq, offset = zip(*pieces, strict=True)
            cols = [doc, start, [len(x) for x in ids], [x.tobytes() for x in ids], total, seq, offset]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECES, strict=True)], schema=_PIECES)

        out: list = []
        for batch in batches:
            for doc, text, group in zip(batch["doc_id"].to_pylist(), batch["text"], batch["part"].to_pylist(), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                if group not in packers:
                    packers[group] = SquareSumPacker(window, new_ids)
                out.extend(packers[group].place(doc, np.array(ids, "<u4")))
                if len(out) >= 2000:
                    yield rows(out)
                    out = []
        for packer in packers.values():
            out.extend(packer.finish())
        for lo in range(0, len(out), 2000):
            yield rows(out[lo : lo + 2000])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                         (F.col(group_col) if group_col else F.lit(None)).cast("string").alias("part"))
    return source.mapInArrow(run, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
