import random

import pytest
from pyspark.sql import functions as F

from mailframe.llm import warc

SCHEMA = "record_id bigint, url string, captured_at bigint, kind string, etag string, last_modified string, headers array<struct<name:string,value:string>>, payload_digest string"


def test_canonical_url(spark):
    urls = {
        "HTTP://www.Example.org:80/a/b/?utm_source=x&z=2&a=1#top": "example.org/a/b?a=1&z=2",
        "https://example.org/a/b?a=1&z=2": "example.org/a/b?a=1&z=2",
        "https://example.org": "example.org",
        "https://example.org/?ref=q": "example.org",
        "": "",
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.canonical_url(F.col("u")).alias("c")).collect()
    assert {r["u"]: r["c"] for r in rows} == urls


@pytest.mark.parametrize("bucket", [10, 1_000_000])
def test_as_of_against_brute_force(spark, bucket):
    rng = random.Random(bucket)
    rows = [(i, "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), rng.choice([None, *range(200)]), rng.random() < 0.4) for i in range(400)]
    df = spark.createDataFrame(rows, "record_id bigint, k string, t bigint, src boolean")
    got = warc.latest_earlier(df, "k", "t", "record_id", F.col("src"), [], bucket=bucket).collect()

    def want(i, k, t):
        if k is None:
            return None
        fits = [((u is not None, u or 0), j) for j, l, u, s in rows if s and l == k and t is not None and (u is None or u < t)]
        return max(fits)[1] if fits else None

    for r in got:
        found = r["as_of"]["record_id"] if r["as_of"] is not None else None
        assert found == want(r["record_id"], r["k"], r["t"]), r


def test_outcomes_and_headers(spark, clashing):
    h = [("Content-Type", "text/html"), ("ETag", "old"), ("Date", "d0")]
    rows = [
        (1, "http://x.org/p", 10, "response", "v1", "m1", h, "sha-1"),
        (2, "https://www.x.org/p/", 20, "response", "v2", None, h, "sha-2"),
        (3, "x.org/p", 15, "revisit", "W/v1", None, [("date", "d1"), ("Content-Type", "no")], None),
        (4, "x.org/p", 20, "revisit", "v1", "m1", None, None),
        (5, "x.org/p", 30, "revisit", "v1", None, None, None),
        (6, "x.org/p", 31, "revisit", None, "m9", None, None),
        (7, "x.org/p", 9, "revisit", "v1", None, None, None),
        (8, None, 40, "revisit", "v1", None, None, None),
        (9, "x.org/p", 12, "revisit", None, "m1", None, None),
        (9, "x.org/p", 12, "revisit", None, "m1", None, None),
        (10, "x.org/p", None, "revisit", "v1", None, None, None),
    ]
    got = warc.resolve_revisits(clashing(spark.createDataFrame(rows, SCHEMA))).collect()
    by = {r["record_id"]: r for r in got}
    assert len(got) == len(rows)
    assert {k: (r["outcome"], r["response_id"]) for k, r in by.items()} == {
        1: ("full", None),
        2: ("full", None),
        3: ("resolved", 1),
        4: ("resolved", 1),
        5: ("validator_mismatch", 2),
        6: ("no_validator", 2),
        7: ("no_earlier_response", None),
        8: ("no_earlier_response", None),
        9: ("resolved", 1),
        10: ("no_earlier_response", None),
    }
    assert [tuple(x) for x in by[3]["resolved_headers"]] == [("Content-Type", "text/html"), ("ETag", "old"), ("date", "d1")]
    assert by[3]["resolved_digest"] == "sha-1" and by[5]["resolved_digest"] is None
    assert warc.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_without_url_are_spread(spark):
    """No window gathers the rows that have no URL."""
    rows = spark.range(2000).withColumn("url", F.col("id").cast("string")).selectExpr("id AS record_id", "IF(id < 0, url, NULL) AS k", "id % 50 AS t", "true AS src")
    got = warc.latest_earlier(rows, "k", "t", "record_id", F.col("src"), [])
    assert got.count() == 2000 and got.filter(F.col("as_of").isNotNull()).count() == 0 and got.columns == ["record_id", "k", "t", "src", "as_of"]
    windows = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line and "AS _near" in line]
    assert windows and all("_spread" in line for line in windows)
