"""Vector codes against a plain k-means in Python integers, and Orchard's search against measuring every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailframe.llm import orchard

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _sorted(rows):
    return sorted(rows, key=repr)


def brute(rows, parts=8, entries=16, rounds=6):
    good = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not good:
        return []
    w = len(good[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in good[:entries]] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        found = [[nearest(cut(v, p), books[p])[1] for p in range(parts)] for _, v, _ in good]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), f in zip(good, found, strict=True) if f[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    text = ",".join(str(x) for book in books for e in book for x in e)
    last = [[nearest(cut(v, p), books[p]) for p in range(parts)] for _, v, _ in good]
    error = [sum(d for d, _ in f) for f in last]
    by_label = {}
    for (_, _, label), e in zip(good, error, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    return _sorted(
        ((i is None, i or 0), label, "".join(f"{k:02x}" for _, k in f), e, by_label[label], hashlib.sha256(text.encode()).hexdigest())
        for (i, _, label), f, e in zip(good, last, error, strict=True)
    )


def result(df):
    return _sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["label"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


def vectors(rng, n, dim=16, spread=1.0):
    return [[float(np.float32(rng.gauss(0, spread))) for _ in range(dim)] for _ in range(n)]


def test_search_measures_no_entry_it_can_rule_out_and_finds_the_nearest():
    rng = np.random.default_rng(1)
    for spread in (1, 3, 1000):  # small spreads give many ties
        entries = rng.integers(-spread, spread + 1, (16, 4))
        entries[7] = entries[2]
        parts = np.concatenate([rng.integers(-spread, spread + 1, (500, 4)), entries])
        index, away = orchard.Codebook(entries).nearest(parts)
        every = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (index == every.argmin(1)).all() and (away == every.min(1)).all()
    one = orchard.Codebook(np.array([[5, 5]]))
    assert one.nearest(np.array([[5, 6]]))[0].tolist() == [0]
    # An entry beyond twice the best distance ends the walk: wrong values behind it are never looked at.
    far = orchard.Codebook(np.array([[0, 0], [1000, 0], [1000, 1000]]))
    far.entries = far.entries.copy()
    far.entries[1:] = [1, 1]
    index, away = far.nearest(np.array([[1, 1]]))
    assert index.tolist() == [0] and away.tolist() == [2]


def test_codes_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, v, rng.choice([0, 1, 1, 1, None])) for i, v in enumerate(vectors(rng, 150))]
    rng.shuffle(rows)
    assert result(orchard.compress(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_ties_repeats_and_unusable_rows(spark, clashing):
    rng = random.Random(6)
    some = vectors(rng, 12, spread=0.001)
    rows = [(i % 9, v, 1) for i, v in enumerate(some)] + [(3, some[0], None), (None, some[1], None), (3, some[0], None)]
    rows += [(-5, None, 1), (-4, [None] + some[0][1:], 1), (-3, [float("nan")] + some[0][1:], 1), (-2, [float("inf")] + some[0][1:], 1), (-1, [float("-inf")] + some[0][1:], 1)]
    got = orchard.compress(clashing(spark.createDataFrame(rows, SCHEMA)))
    assert result(got) == brute(rows)
    assert result(orchard.compress(spark.createDataFrame([*rows, (50, [1.0, 2.0], 1), (51, [], 1)], SCHEMA))) == brute(rows)  # other lengths


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [None], 0)]])
def test_no_usable_rows(spark, rows):
    assert orchard.compress(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_lengths_that_do_not_divide_and_large_components(spark):
    rows = [(1, [1e30] * 10, 0), (2, [-1e30] * 10, 0), (3, [0.5] * 10, 0)]
    got = orchard.compress(spark.createDataFrame(rows, SCHEMA)).orderBy("vec_id").collect()
    assert [r["error"] for r in got] == [0, 0, 0] and [len(r["code"]) for r in got] == [16] * 3
    assert [r["code"][:2] for r in got] == ["00", "01", "02"]


def test_any_partitioning_gives_the_same_codebooks(spark):
    rng = random.Random(7)
    rows = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors(rng, 60, 8))], SCHEMA)
    seen = {orchard.compress(rows.repartition(n)).agg(F.max("codebooks_sha256"), F.sum("error")).first() for n in (1, 7)}
    assert len(seen) == 1
