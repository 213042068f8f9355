"""Scores against matrix products, mined negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailframe.llm import four_russians
from mailframe.llm.four_russians import Best, Scorer

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def anchor():
    return F.col("vec_id") % 10 == 0


def brute(rows, every=10):
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, av, al in good:
        if a is None or a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v, strict=True)), i is None, i or 0, label == al) for i, v, label in good if i != a)
        for ps, pn, p, same in [x for x in scored if x[3]][:5]:
            fit = [x for x in scored if not x[3] and 30 * -ps <= 100 * -x[0] <= 90 * -ps][:10]
            out += [(a, None if pn else p, r, None if n else i, -ps, -s) for r, (s, n, i, _) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows_of(rng, n, dim=16, labels=4):
    return [(i, [float(np.float32(rng.gauss(0.3, 0.4))) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("reach", [1, 2, 127, 128, 5000, 1 << 22])
def test_scores_equal_matrix_products(reach):
    rng = np.random.default_rng(reach)
    for dim in (1, 7, 8, 9, 64):
        anchors, rows = rng.integers(-reach, reach + 1, (5, dim)), rng.integers(-reach, reach + 1, (30, dim))
        rows[0], anchors[0] = -reach, -reach
        assert (Scorer(anchors).scores(rows) == rows @ anchors.T).all()
    assert (Scorer(anchors).scores(np.zeros((3, dim), np.int64)) == 0).all()
    assert Scorer(anchors[:, :0]).scores(rows[:, :0]).tolist() == [[0] * 5] * 30


def test_best_keeps_ties_by_id_over_many_chunks():
    rng = np.random.default_rng(2)
    score, ids = rng.integers(0, 4, (300, 3)), rng.permutation(300)
    allowed = rng.random((300, 3)) < 0.7
    best = Best(3, 10)
    for lo in range(0, 300, 37):
        best.add(score[lo : lo + 37], ids[lo : lo + 37], allowed[lo : lo + 37])
    for k in range(3):
        want = sorted((-s, i) for s, i, ok in zip(score[:, k].tolist(), ids.tolist(), allowed[:, k], strict=True) if ok)[:10]
        mine = best.list == k
        assert list(zip((-best.score[mine]).tolist(), best.id[mine].tolist(), strict=True)) == want


def test_negatives_equal_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    rows = rows_of(rng, 200)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    want = brute(rows)
    assert len(want) > 300 and result(four_russians.mine(df, anchor())) == want
    monkeypatch.setattr(four_russians, "ANCHORS", 3)  # several blocks
    monkeypatch.setattr(four_russians, "CHUNK", 17)
    assert result(four_russians.mine(df, anchor())) == want


def test_ties_nulls_and_unusable_rows(spark, clashing):
    rng = random.Random(9)
    base = [1.0, 0.5, -0.25, 2.0]
    rows = [(i, base if i % 3 else [0.5, 0.25, -0.125, 1.0], i % 2) for i in range(30)]
    rows += [(None, base, 0), (None, [0.5, 0.25, -0.125, 1.0], 1), (100, base, None), (110, None, 1), (120, [None, 1.0, 1.0, 1.0], 1), (130, [float("nan"), 1.0, 1.0, 1.0], 1)]
    rows += [(140, [float("inf"), 0.0, 0.0, 0.0], 0)]
    rng.shuffle(rows)
    assert result(four_russians.mine(clashing(spark.createDataFrame(rows, SCHEMA)), anchor())) == brute(rows)
    short = [*rows, (200, [1.0], 1), (210, [], 1)]
    assert result(four_russians.mine(spark.createDataFrame(short, SCHEMA), anchor())) == brute(rows)


def test_repeated_rows(spark):
    """Copies of a candidate take a place each; copies of an anchor each give their rows."""
    high, low = [1.0, 0.0], [0.5, 0.0]
    one = [(10, high, 0), (1, high, 0), (2, low, 1)]
    twice = result(four_russians.mine(spark.createDataFrame([*one, (2, low, 1), (10, high, 0)], SCHEMA), anchor()))
    single = result(four_russians.mine(spark.createDataFrame(one, SCHEMA), anchor()))
    assert single == [(10, 1, 1, 2, 65536, 32768)]
    assert twice == sorted([(10, 1, r, 2, 65536, 32768) for r in (1, 2)] * 2, key=repr)


@pytest.mark.parametrize("rows", [[], [(0, None, 0)], [(0, [1.0], 0)], [(1, [1.0], 0), (2, [1.0], 1)], [(0, [1.0], 0), (1, [1.0], 0)]])
def test_nothing_to_mine(spark, rows):
    got = four_russians.mine(spark.createDataFrame(rows, SCHEMA), anchor())
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and got.count() == 0


def test_negative_scores_and_zero(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-0.5, 0.0], 1), (10, [0.0, 1.0], 2), (11, [1.0, 0.0], 2), (12, [1.0, 0.0], 3)]
    assert result(four_russians.mine(spark.createDataFrame(rows, SCHEMA), anchor())) == brute(rows)
