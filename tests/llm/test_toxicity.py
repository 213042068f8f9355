import random

import numpy as np
from pyspark.sql import functions as F

from mailframe.llm import toxicity
from mailframe.llm.queries import op8_toxicity
from tests.conftest import SF_ORACLE
from tests.llm.conftest import words


def _fit(spark, rows):
    return toxicity.fit(spark.createDataFrame(rows, "place bigint, label int, text string"))


def _score(df, model):
    return {r["doc_id"]: r["s"] for r in df.select("doc_id", toxicity.score(df, model, F.col("text")).alias("s")).collect()}


def test_features_are_words_pairs_and_skips():
    data = np.frombuffer(b"a b cA b c", np.uint8)
    first, second = toxicity.bag(data, np.array([0, 5, 10]))
    assert len(first) == 1 + 3 + 2 + 1 and (first == second).all()


def test_learns_a_word_and_a_pair(spark, documents):
    rng = random.Random(2)
    rows = []
    for i in range(1500):
        w = words(rng, 20).split()
        bad = i % 3 == 0
        w.insert(5, ("zap" if i % 2 else "zig zag") if bad else rng.choice(["zig", "zag", "ok"]))
        rows.append((i, int(bad), " ".join(w)))
    model = _fit(spark, rows)
    assert 0 < len(model.bins) < 3000
    got = _score(documents([(1, "ka lo zap mi"), (2, "ka lo zig zag mi"), (3, "ka lo zag zig mi"), (4, "ka lo mi")]), model)
    assert got[1] > 0.3 and got[2] > 0.3 and got[3] < 0.3 and got[4] < 0.3


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").select("doc_id", "toxic")
    got = op8_toxicity(spark, SF_ORACLE).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got[got["toxic"] == 0]["score"].to_numpy(), got[got["toxic"] == 1]["score"].to_numpy()
    auc = (bad[:, None] > good[None, :]).mean() + 0.5 * (bad[:, None] == good[None, :]).mean()
    assert auc > 0.75  # from 300 labelled rows
    assert (got["predicted"] == (got["score"] >= 0.3)).all()


def test_edge_rows(spark, documents, clashing):
    model = _fit(spark, [(1, 1, "bad thing"), (1, 1, "bad thing"), (2, 0, None), (3, None, "x"), (4, 0, "")])
    rows = clashing(documents([(1, None), (2, ""), (3, "bad " * 60_000), (None, "bad"), (4, "good")]))
    got = _score(rows, model)
    assert len(got) == 5 and all(0 <= s <= 1 for s in got.values()) and got[1] == got[2]
    empty = rows.limit(0)
    assert empty.select(toxicity.score(empty, model, F.col("text"))).count() == 0
    assert set(_score(rows, _fit(spark, [])).values()) == {0.5}


def test_sample_is_bounded_and_by_hash(spark, documents):
    docs = documents([(i, f"t {i}") for i in range(100)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(5, None)], "doc_id bigint, toxic int")
    got = toxicity.training_rows(docs, labels, rows=30).collect()
    assert len(got) == 30 and len({r["place"] for r in got}) == 30
