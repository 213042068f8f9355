import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from mailframe.llm import packing
from mailframe.llm.queries import op7_packing
from tests.conftest import SF_ORACLE


def _check(pieces, tokens):
    """Each document's pieces give its ids back; sequences are gapless, full or a power of two."""
    docs, sequences = {}, {}
    for doc, start, ids, total, seq, offset in pieces:
        docs.setdefault(doc, []).append((start, np.asarray(ids), total))
        sequences.setdefault(seq, []).append((offset, len(ids)))
    assert set(docs) == set(tokens)
    for doc, parts in docs.items():
        parts.sort(key=lambda p: p[0])
        at = 0
        for start, ids, total in parts:
            assert start == at and total == len(tokens[doc]) and len(ids)
            at += len(ids)
        assert np.concatenate([p[1] for p in parts]).tolist() == list(tokens[doc])
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == packing.WINDOW or at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("seed", range(5))
def test_packer(seed):
    rng = random.Random(seed)
    tokens = {d: np.arange(rng.choice([1, 5, 300, 1023, 1024, 1025, rng.randint(1, 5000)])) for d in range(300)}
    packer, pieces = packing.SquareSumPacker(), []
    for d, ids in tokens.items():
        pieces += packer.place(d, ids)
    whole = sum(1 for p in pieces if p[1] % packing.WINDOW == 0)
    assert whole and packer.levels.sum() < 300
    pieces += packer.finish()
    _check(pieces, tokens)


def test_level_minimises_squared_counts():
    rng = random.Random(1)
    packer = packing.SquareSumPacker(window=16)
    for d in range(500):
        size = rng.randint(1, 15)

        def after(level, size=size):
            counts = packer.levels.copy()
            if level:
                counts[level] -= 1
            if level + size < 16:
                counts[level + size] += 1
            return int((counts[1:16] ** 2).sum())

        open_ = [h for h in range(17 - size) if h == 0 or packer.levels[h]]
        assert after(packer.level_for(size)) == min(map(after, open_))
        list(packer.place(d, np.arange(size)))


def test_same_ids_as_tokenizers(spark):
    path = packing.tokenizer_path()
    want, encode = Tokenizer.from_file(path), packing.load_encoder(path)
    texts = [r["text"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("text").limit(200).collect()]
    texts += ["", " ", "\n\n\t x", "<|endoftext|>a<|endoftext|>", "naïve — 日本語 🙂‍↔️ ​\x00", "a" * 5000, "don't I'LL 12345 !!??", "\r\n  \r\n"]
    for t in texts:
        assert encode(t) == want.encode(t, add_special_tokens=False).ids


def test_query_round_trip(spark):
    encode = packing.load_encoder(packing.tokenizer_path())
    tokens = {r["doc_id"]: encode(r["text"]) + [0] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()}
    rows = op7_packing(spark, SF_ORACLE).collect()
    pieces = []
    for r in rows:
        ids = tokens[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        pieces.append((r["doc_id"], r["start"], ids, r["doc_tokens"], r["sequence_id"], r["offset"]))
    _check(pieces, tokens)


def test_edge_rows(spark, documents, clashing):
    rows = clashing(documents([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "word " * 40_000)]).repartition(2))
    got = packing.pack(rows, packing.tokenizer_path()).collect()
    assert sum(r["length"] for r in got if r["doc_id"] in (1, 2)) == 2
    assert sum(r["length"] for r in got if r["doc_id"] == 3) == 2 * (packing.load_encoder(packing.tokenizer_path())("a b").__len__() + 1)
    assert sum(r["length"] for r in got if r["doc_id"] == 4) == max(r["doc_tokens"] for r in got)
    assert packing.pack(rows.limit(0), packing.tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_whole_run_against_brute_force(seed):
    """Every placement by trying all open windows and squaring all counts anew; ties to the fullest, then the latest window."""
    rng, window = random.Random(seed), 32
    packer, closed = packing.SquareSumPacker(window=window), {}
    opened: list[list[tuple[int, int]]] = []  # windows as (document, tokens), by the time of their last change
    full = []

    def fill(pieces):
        return sum(n for _, n in pieces)

    def squares(fills):
        return sum(fills.count(f) ** 2 for f in set(fills) if f < window)

    for d in range(400):
        size = rng.randint(1, 80)
        for piece in packer.place(d, np.arange(size)):
            closed.setdefault(piece[4], []).append((piece[0], len(piece[2])))
        full += [[(d, window)]] * (size // window)
        rest = size % window
        if not rest:
            continue
        tried = []
        for i, pieces in enumerate([[], *opened]):
            if fill(pieces) + rest <= window:
                others = [fill(p) for j, p in enumerate(opened) if j != i - 1]
                tried.append((squares([*others, fill(pieces) + rest]), -fill(pieces), -i))
        at = -min(tried)[2]
        pieces = [*(opened.pop(at - 1) if at else []), (d, rest)]
        (full if fill(pieces) == window else opened).append(pieces)
    assert sorted(closed.values()) == sorted(full)
    assert sorted(fill(p) for p in opened) == [f for f in range(window) for _ in range(packer.levels[f])]
