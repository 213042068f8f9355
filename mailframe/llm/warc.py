"""Resolution of not-modified revisits in web archives.

A revisit (304) record holds no payload.  It is joined as of its time with the latest earlier
full response of the same canonical URL.  The validators must agree: the entity tags by weak
comparison if both sides have one, else the modification dates.  The resolved record has the
stored headers, updated by those headers that a 304 may update.

The as-of join runs per (URL, time bucket): within a bucket by a window, and across buckets by
the last response of each bucket, carried on.  A URL with any number of captures is spread over
its buckets; rows without URL or time, which nothing precedes, are spread within a bucket.

Defined results: a null URL matches nothing; of responses with one time the largest record id is
the latest; a response at the revisit's own time is not earlier; a null time comes before all
others; null header lists are empty; repeated rows give repeated results; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds in a time bucket.
BUCKET = 86_400
#: Groups of a bucket's rows that have no URL or no time.
SPREAD = 1024
#: Headers that a not-modified response may update (lower case).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Query parameters that only track.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without end slash, sorted parameters without trackers; no scheme, no fragment."""
    rest = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def latest_earlier(events: DataFrame, key: str, time: str, order: str, is_source: Column, carried: list[str], bucket: int = BUCKET) -> DataFrame:
    """All rows with ``as_of``: struct of ``time``, ``order`` and ``carried`` of the latest source row of the key with a smaller time, or null."""
    found = F.struct(time, order, *carried)
    rows = events.withColumn("_bucket", F.floor(F.col(time) / bucket)).withColumn("_source", F.when(is_source, found))
    # Within a bucket: the greatest source of a smaller time; a null time is smaller than any other.
    # Rows without key or time have no earlier source, so they need not meet: they are spread.
    alone = F.col(key).isNull() | F.col(time).isNull()
    rows = rows.withColumn("_spread", F.when(alone, F.pmod(F.xxhash64(order), F.lit(SPREAD))).otherwise(0))
    within = Window.partitionBy(key, "_bucket", "_spread").orderBy(F.col(time).asc_nulls_first()).rangeBetween(Window.unboundedPreceding, -1)
    near = F.when(F.col(key).isNotNull() & F.col(time).isNotNull(), F.col("_near"))
    rows = rows.withColumn("_near", F.max("_source").over(within))

    # Before a bucket: the last response of the nearest earlier bucket that has one.
    each = rows.filter(F.col(key).isNotNull()).groupBy(key, "_bucket").agg(F.max("_source").alias("_last"))  # one row per bucket of a key
    earlier = Window.partitionBy(key).orderBy(F.col("_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    carry = each.select(F.col(key).alias("_key"), F.col("_bucket").alias("_at"), F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    joined = rows.join(carry, (F.col(key) == F.col("_key")) & F.col("_bucket").eqNullSafe(F.col("_at")), "left")
    return joined.withColumn("as_of", F.coalesce(near, F.col("_before"))).drop("_bucket", "_source", "_spread", "_near", "_key", "_at", "_before")


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers with the permitted ones of the update in their place; both array<struct<name, value>>."""
    none = F.array().cast("array<struct<name:string,value:string>>")
    allowed = F.filter(F.coalesce(update, none), lambda h: F.lower(h["name"]).isin(PERMITTED))
    names = F.transform(allowed, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(F.coalesce(stored, none), lambda h: ~F.array_contains(names, F.lower(h["name"]))), allowed)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records (record_id, url, captured_at seconds, kind, etag, last_modified, headers, payload_digest) with their resolution.

    Adds ``canonical``, ``response_id``, ``outcome``, ``resolved_headers`` and ``resolved_digest``.  Outcomes: ``full`` for a
    response; for a revisit ``resolved``, ``no_earlier_response``, ``no_validator`` or ``validator_mismatch``.
    """
    rows = records.select(
        "record_id", "url", "captured_at", "kind", "etag", "last_modified", "headers", "payload_digest", canonical_url(F.col("url")).alias("canonical")
    )
    is_response = F.col("kind") == "response"
    joined = latest_earlier(rows, "canonical", "captured_at", "record_id", is_response, ["etag", "last_modified", "headers", "payload_digest"])
    stored = F.col("as_of")

    def weak(tag: Column) -> Column:
        return F.regexp_replace(tag, r"^W/", "")

    tags = F.col("etag").isNotNull() & stored["etag"].isNotNull()
    dates = F.col("last_modified").isNotNull() & stored["last_modified"].isNotNull()
    agree = F.when(tags, weak(F.col("etag")) == weak(stored["etag"])).when(dates, F.col("last_modified") == stored["last_modified"])
    outcome = (
        F.when(F.coalesce(is_response, F.lit(False)), "full")
        .when(stored.isNull(), "no_earlier_response")
        .when(agree.isNull(), "no_validator")
        .when(agree, "resolved")
        .otherwise("validator_mismatch")
    )
    done = joined.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    full = F.col("outcome") == "full"
    return done.select(
        "record_id",
        "url",
        "canonical",
        "captured_at",
        "kind",
        "outcome",
        F.when(~full, stored["record_id"]).alias("response_id"),
        F.when(full, F.col("headers")).when(resolved, merged_headers(stored["headers"], F.col("headers"))).alias("resolved_headers"),
        F.when(full, F.col("payload_digest")).when(resolved, stored["payload_digest"]).alias("resolved_digest"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Archive records derived from the pages table: a response of each page, and a revisit of its URL, of which some validators do not fit."""
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256)
    n, id_ = F.col("page_id"), F.col("page_id").cast("string")

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    base = pages.select("page_id", "url", digest.alias("digest"))
    response = base.select(
        (n * 2).alias("record_id"),
        "url",
        (n * 600).alias("captured_at"),
        F.lit("response").alias("kind"),
        F.when(n % 11 != 0, F.col("digest")).alias("etag"),
        (n % 97).cast("string").alias("last_modified"),
        F.array(header("Content-Type", F.lit("text/html")), header("Date", id_), header("Server", F.concat(F.lit("s"), (n % 3).cast("string")))).alias("headers"),
        F.col("digest").alias("payload_digest"),
    )
    revisit = base.select(
        (n * 2 + 1).alias("record_id"),
        "url",
        (n * 600 + (n % 7 - 1) * 50_000).alias("captured_at"),
        F.lit("revisit").alias("kind"),
        F.when(n % 5 == 0, "stale").when(n % 3 != 0, F.concat(F.lit("W/"), F.col("digest"))).alias("etag"),
        F.when(n % 4 != 0, (n % 97).cast("string")).alias("last_modified"),
        F.array(header("date", F.concat(F.lit("r"), id_)), header("Content-Type", F.lit("dropped"))).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"),
    )
    return response.unionByName(revisit)


RESOLVE_SQL = r"""
WITH p AS (SELECT page_id, url, sha256(coalesce(html, '')) AS digest,
    regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
c AS (SELECT page_id, digest,
    regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*', 0)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)'))), '&') AS params FROM p),
k AS (SELECT page_id, digest, place || CASE WHEN params <> '' THEN '?' || params ELSE '' END AS canonical FROM c),
s AS (SELECT page_id * 2 AS record_id, canonical, page_id * 600 AS t, CASE WHEN page_id % 11 <> 0 THEN digest END AS etag,
    CAST(page_id % 97 AS VARCHAR) AS modified, page_id, digest FROM k),
r AS (SELECT page_id * 2 + 1 AS record_id, canonical, page_id * 600 + (page_id % 7 - 1) * 50000 AS t,
    CASE WHEN page_id % 5 = 0 THEN 'stale' WHEN page_id % 3 <> 0 THEN 'W/' || digest END AS etag,
    CASE WHEN page_id % 4 <> 0 THEN CAST(page_id % 97 AS VARCHAR) END AS modified, page_id FROM k),
j AS (SELECT r.record_id, r.canonical, r.page_id, s.record_id AS response_id, s.page_id AS stored_page, s.digest,
    CASE WHEN s.record_id IS NULL THEN 'no_earlier_response'
      WHEN r.etag IS NOT NULL AND s.etag IS NOT NULL THEN
        CASE WHEN regexp_replace(r.etag, '^W/', '') = s.etag THEN 'resolved' ELSE 'validator_mismatch' END
      WHEN r.modified IS NULL THEN 'no_validator'
      WHEN r.modified = s.modified THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
  FROM r ASOF LEFT JOIN s ON r.canonical = s.canonical AND r.t > s.t)
SELECT record_id, canonical, 'full' AS outcome, NULL::BIGINT AS response_id,
  'Content-Type: text/html|Date: ' || page_id || '|Server: s' || (page_id % 3) AS headers, digest AS payload_sha256 FROM s
UNION ALL
SELECT record_id, canonical, outcome, response_id,
  CASE WHEN outcome = 'resolved' THEN 'Content-Type: text/html|Server: s' || (stored_page % 3) || '|date: r' || page_id END,
  CASE WHEN outcome = 'resolved' THEN digest END FROM j
"""
