"""Mailbox views derived from the driver's ``events`` table (rules in FIXTURES.md §3).

The driver's tables hold no mail.  ``mailbox`` turns every event into one listed
message; ``stored`` is what an earlier poll stored, ``server`` what the server
lists now (some expunged, some with changed flags).  Each view exists twice: as a
Spark DataFrame and as a DuckDB CTE, so every query can be checked against an
oracle on the same parquet files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailframe.operators.numbering import number_within_group
from mailframe.sources.tables import read_table

# Fixed values of the fixture
ACCOUNT_DOMAIN = "example.com"
MAIL_HOST = "mail.example.com"
STORED_FRACTION = (4, 5)  # stored = uid <= max(uid) * 4 div 5
EXPUNGE_EVERY = 11  # server lacks uid % 11 = 0
FLAG_CHANGE_EVERY = 5  # server flips the Seen bit (32) where uid % 5 = 0
POP_MISSING_EVERY = 13  # pop_stored lacks uid % 13 = 0


def _account_no() -> F.Column:
    return (F.col("user_id") % 3).cast("string")


def mailbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        (F.col("event_id") + 1).alias("uid"),
        F.concat(F.lit("user"), _account_no(), F.lit("@" + ACCOUNT_DOMAIN)).alias("account"),
        F.col("event_type").alias("folder_full_name"),
        F.concat(
            F.lit("imap://user"), _account_no(), F.lit(f"%40{ACCOUNT_DOMAIN}@{MAIL_HOST}/"), F.col("event_type")
        ).alias("folder_uri"),
        F.col("ts").alias("received_date"),
        ((F.col("event_id") * 7 + F.col("user_id")) % 64).cast("int").alias("flaghashcode"),
        "value",
        "props",
    )


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    mb = mailbox(spark, sf_dir)
    num, den = STORED_FRACTION
    mark = mb.agg(F.expr(f"max(uid) * {num} div {den}")).scalar()
    return mb.filter(F.col("uid") <= mark)


def server(spark: SparkSession, sf_dir: str) -> DataFrame:
    mb = mailbox(spark, sf_dir)
    return mb.filter(F.col("uid") % EXPUNGE_EVERY != 0).withColumn(
        "flaghashcode",
        F.when(F.col("uid") % FLAG_CHANGE_EVERY == 0, ((F.col("flaghashcode") + 32) % 64).cast("int")).otherwise(
            F.col("flaghashcode")
        ),
    )


def pop_server(spark: SparkSession, sf_dir: str) -> DataFrame:
    srv = server(spark, sf_dir).withColumn("pop_id", F.col("uid").cast("string"))
    return number_within_group(srv, ["folder_uri"], "uid", "msg_num")


def pop_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        stored(spark, sf_dir)
        .filter(F.col("uid") % POP_MISSING_EVERY != 0)
        .withColumn("pop_id", F.col("uid").cast("string"))
    )


# DuckDB forms of the same views, used by the oracle SQL.
SQL_VIEWS = {
    "mailbox": f"""mailbox AS (
  SELECT event_id + 1 AS uid,
         'user' || CAST(user_id % 3 AS VARCHAR) || '@{ACCOUNT_DOMAIN}' AS account,
         event_type AS folder_full_name,
         'imap://user' || CAST(user_id % 3 AS VARCHAR) || '%40{ACCOUNT_DOMAIN}@{MAIL_HOST}/' || event_type AS folder_uri,
         ts AS received_date,
         CAST((event_id * 7 + user_id) % 64 AS INTEGER) AS flaghashcode,
         value, props
  FROM events)""",
    "stored": f"""stored AS (
  SELECT * FROM mailbox
  WHERE uid <= (SELECT max(uid) * {STORED_FRACTION[0]} // {STORED_FRACTION[1]} FROM mailbox))""",
    "server": f"""server AS (
  SELECT uid, account, folder_full_name, folder_uri, received_date,
         CASE WHEN uid % {FLAG_CHANGE_EVERY} = 0 THEN CAST((flaghashcode + 32) % 64 AS INTEGER)
              ELSE flaghashcode END AS flaghashcode,
         value, props
  FROM mailbox WHERE uid % {EXPUNGE_EVERY} <> 0)""",
    "pop_server": """pop_server AS (
  SELECT *, CAST(uid AS VARCHAR) AS pop_id,
         CAST(row_number() OVER (PARTITION BY folder_uri ORDER BY uid) AS INTEGER) AS msg_num
  FROM server)""",
    "pop_stored": f"""pop_stored AS (
  SELECT *, CAST(uid AS VARCHAR) AS pop_id FROM stored WHERE uid % {POP_MISSING_EVERY} <> 0)""",
}

_DEPENDS = {
    "mailbox": [],
    "stored": ["mailbox"],
    "server": ["mailbox"],
    "pop_server": ["server"],
    "pop_stored": ["stored"],
}


def with_views(*names: str) -> str:
    """``WITH`` clause holding the named views and what they depend on, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPENDS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(SQL_VIEWS[n] for n in order) + "\n"
