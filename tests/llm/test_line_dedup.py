"""Line dedup against brute force; runs, levels and plan of the index."""

import random
import re

import pytest
from pyspark.sql import functions as F

from mailframe.llm import line_dedup
from mailframe.llm.line_dedup import LineIndex
from tests.llm.conftest import words

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(WHITE).translate({c: c + 32 for c in range(65, 91)})


def brute(rows):
    order = lambda i: (i is None, i or 0)
    least = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                least[key(line)] = min(least.get(key(line), order(i)), order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or least[key(x)] == order(i)]
        out.append((order(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def result(docs, **more):
    got = line_dedup.drop_repeated_lines(docs, **more).collect()
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_lines"], r["n_dropped"], r["kept"]) for r in got)


def corpus(rng, n=60):
    shared = [words(rng, 4) for _ in range(12)]
    rows = []
    for i in range(n):
        lines = [rng.choice(shared) if rng.random() < 0.4 else words(rng, rng.randint(0, 5)) for _ in range(rng.randint(0, 9))]
        lines = [x.upper() if rng.random() < 0.2 else rng.choice(["", " ", "\t", "\r"]) + x + rng.choice(["", "  ", "\r"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rng.shuffle(rows)
    return rows


def test_lines_equal_brute_force(spark, documents):
    rows = corpus(random.Random(1))
    assert result(documents(rows).repartition(5)) == brute(rows)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (7, 2), (5, 3)])
def test_any_number_of_batches_and_levels(spark, documents, monkeypatch, batches, fanout):
    monkeypatch.setattr(line_dedup, "BATCHES", batches)
    monkeypatch.setattr(line_dedup, "FANOUT", fanout)
    rows = corpus(random.Random(batches), 40)
    assert result(documents(rows)) == brute(rows)


def test_edge_rows(spark, documents, clashing):
    long = "\n".join(f"line number {k} of a long text" for k in range(3000))
    rows = [(5, "the same line\nown line five"), (3, "The Same Line \nother words"), (9, None), (8, ""), (7, "\n\n"), (None, "the same line\nnull line here"), (None, "null line here\n the same LINE")]
    rows += [(5, "OWN line five\nanother row"), (5, "the same line\nown line five"), (20, long), (21, long + "\nlast line is new"), (30, "short\nshort"), (31, "short"), (-4, "negative id line"), (32, "negative id line")]
    rows += [(40, "ÄÖÜ ÄÖÜ ÄÖÜ"), (41, "äöü äöü äöü"), (50, "twice here it is\ntwice here it is"), (51, "twice here it is"), (60, "0123456789"), (61, " 0123456789\x0b"), (62, "012345678"), (63, "012345678")]
    rows += [(70, " padded line "), (71, "padded line"), (80, "no break space"), (81, "no break space")]
    assert result(documents(rows)) == brute(rows)
    extra = clashing(documents(rows)).withColumns({c: F.lit("x") for c in ("doc", "holder", "text_hash", "pos", "line", "line_key", "batch", "line_verdict", "line_result")})
    assert result(extra) == brute(rows)
    out = line_dedup.drop_repeated_lines(extra)
    assert set(extra.columns) <= set(out.columns) and {r["line_verdict"] + r["doc"] for r in out.select("doc", "line_verdict").collect()} == {"xx"}
    assert result(documents(rows).limit(0)) == []


def test_a_hot_line_goes_another_way_with_the_same_result(spark, documents, monkeypatch):
    rows = [(i, f"the very common line\nonly here in {i}\nshared by some {i % 7}") for i in range(80)]
    want = brute(rows)
    for share in (2, 5, 1_000_000):
        monkeypatch.setattr(line_dedup, "HOT_SHARE", share)
        assert result(documents(rows)) == want


def test_levels_fill_and_compact(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FANOUT", 2)
    index, sizes = LineIndex(spark), []
    for b in range(5):
        lines = spark.createDataFrame([((False, b), 7, p, b * 10 + p, 1) for p in range(3)] + [((False, b), 7, 9, -1, 1)], "doc struct<none:boolean,id:bigint>, text_hash bigint, pos int, k1 bigint, k2 bigint")
        gone = line_dedup.add_batch(index, lines)
        assert sorted(r["pos"] for r in gone.collect()) == ([9] if b else [])
        sizes.append([len(level) for level in index.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    keys = [(r["k1"], r["holder"]["id"]) for run in index.runs() for r in run.collect()]
    assert sorted(keys) == sorted([(-1, 0)] + [(b * 10 + p, b) for b in range(5) for p in range(3)])  # each hash once over all runs
    index.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_a_compacted_run_has_one_file_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FANOUT", 3)
    index = LineIndex(spark)
    for b in range(9):
        index.add(spark.createDataFrame([(b * 100 + k, k, (False, b)) for k in range(100)], "k1 bigint, k2 bigint, holder struct<none:boolean,id:bigint>"))
    assert [len(level) for level in index.levels] == [0, 0, 1]
    run = index.runs()[0]
    buckets = [re.search(r"_(\d{5})\.", f)[1] for f in run.inputFiles()]
    assert len(buckets) == len(set(buckets)) == line_dedup.shuffle_partitions(spark)
    assert sorted(r["k1"] for r in run.collect()) == list(range(900))
    index.close()


def test_runs_are_merged_without_a_shuffle(spark):
    index = LineIndex(spark)
    rows = spark.createDataFrame([(k, k, (False, 1)) for k in range(50)], "k1 bigint, k2 bigint, holder struct<none:boolean,id:bigint>")
    index.add(rows)
    keys = rows.groupBy("k1", "k2").agg(F.max("holder").alias("least")).withColumn("holder", F.lit(None).cast("struct<none:boolean,id:bigint>"))
    plan = index.holders(keys)._jdf.queryExecution().executedPlan().toString()
    right = plan[plan.index("SortMergeJoin") :]
    assert "Bucketed: true" in plan and right.count("Exchange") == 1  # the batch's own aggregation
    index.close()


def test_only_native_operators(documents):
    plan = line_dedup.drop_repeated_lines(documents([(1, "some text of a line"), (2, "some text of a line")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
