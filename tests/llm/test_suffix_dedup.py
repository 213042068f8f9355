import collections
import random
import time

import numpy as np
import pytest

from mailframe.llm import suffix_dedup as S
from tests.conftest import SF_SMALL
from tests.llm.conftest import words


def brute(texts, length):
    """(bytes, removed, runs removed, rest) of each text, by counting every window."""
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.diff(np.r_[0, gone.astype(int)])
        out.append((len(t), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_shard_and_merge_against_counting(seed):
    rng = np.random.default_rng(seed)
    contents = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(5, 60)).astype(np.uint8)) for _ in range(rng.integers(1, 6))]
    length = int(rng.integers(2, 12))
    shard = S.Shard(contents, length)
    count = collections.Counter(c[i : i + length] for c in contents for i in range(len(c) - length + 1))
    other = S.Shard([bytes(rng.integers(97, 99, 40).astype(np.uint8))], length)
    got, merged = shard.repeated(), shard.found_in(other)
    for c, s in zip(contents, shard.starts, strict=True):
        for i in range(len(c)):
            w = c[i : i + length]
            assert got[s + i] == (len(w) == length and count[w] > 1)
            assert merged[s + i] == (len(w) == length and w in bytes(other.raw))


def test_suffix_array_order():
    rng = np.random.default_rng(1)
    symbols = rng.integers(1, 4, 300).astype(np.uint16)
    order = S.suffix_array(symbols, 300)
    want = sorted(range(300), key=lambda i: symbols[i:].tolist())
    assert order.tolist() == want


def test_order_ends_at_separators_and_without_one_word(monkeypatch):
    rng = np.random.default_rng(2)
    for seed in range(20):
        monkeypatch.setattr(S, "_TIE_BITS", 63 if seed % 2 else 0)
        symbols = rng.integers(0, 3, 400).astype(np.uint16)
        room = [int(np.r_[np.flatnonzero(symbols[i:] == 0), 400 - i][0]) for i in range(400)]
        order = S.suffix_array(symbols, 30).tolist()
        heads = [symbols[i : i + min(30, room[i])].tolist() for i in order]
        assert heads == sorted(heads)
        assert sorted(order) == list(range(400))


def test_matches_longer_than_the_limit():
    """Places behind a long match count down from its true length."""
    rng = np.random.default_rng(3)
    long = bytes(rng.integers(0, 256, 5000).astype(np.uint8))
    shard = S.Shard([b"left" + long + b"one", b"other" + long + b"two"], 400)
    shared = S.common_prefixes(shard.symbols, shard.order, 400)
    assert shared.max() == 400
    assert int((shared == 400).sum()) == 5000 - 400 + 1
    assert shard.repeated().sum() == 2 * (5000 - 400 + 1)


def test_shard_costs_few_plain_sorts():
    """Contents that share long passages: building a shard and finding its repeats against one stable sort of as many words."""
    rng = np.random.default_rng(4)
    contents = []
    for _ in range(100):
        base = rng.integers(97, 123, 700).astype(np.uint8)
        for _ in range(8):
            one = base.copy()
            one[: rng.integers(0, 320)] = 32
            one[rng.integers(420, 700)] = 33
            contents.append(bytes(one))
    keys = rng.integers(0, 1 << 60, sum(map(len, contents)))

    def cost(job):
        spent = []
        for _ in range(3):
            start = time.process_time()
            job()
            spent.append(time.process_time() - start)
        return min(spent)

    ratio = cost(lambda: S.Shard(contents).repeated()) / cost(lambda: np.argsort(keys, kind="stable"))
    assert ratio < 8, ratio


def _run(spark, documents, rows, **args):
    got = S.remove_repeats(documents(rows), **args).collect()
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got)


def _want(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    return sorted((i is not None, i or 0, *b) for (i, _), b in zip(rows, brute(texts, length), strict=True))


@pytest.mark.parametrize("part", [2000, 2])
def test_planted_repeats(spark, documents, part):
    rng = random.Random(part)
    passage, copy = words(rng, 30), words(rng, 60)
    rows = [(i, words(rng, rng.randint(5, 60))) for i in range(12)]
    rows += [(20 + i, words(rng, 10 + i) + " " + passage + " " + words(rng, 7)) for i in range(9)]
    rows += [(40, copy), (41, copy), (41, copy), (None, copy), (42, None), (43, ""), (44, "ä" * 150), (45, words(rng, 4000) + passage)]
    rows += [(50, passage + passage), (51, "abc" * 200)]
    assert _run(spark, documents, rows, length=100, gram=24, part=part) == _want(rows, 100)


def test_empty_table_and_clashing_names(spark, documents, clashing):
    rows = documents([(1, "x" * 500), (2, "x" * 500)])
    assert S.remove_repeats(clashing(rows).limit(0)).count() == 0
    assert {r["n_removed"] for r in S.remove_repeats(clashing(rows)).collect()} == {500}


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = S.remove_repeats(docs).collect()
    assert sorted((True, r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == _want(rows, S.LENGTH)
