"""Change log store: upsert order, tombstones, clears, compaction, error sink, recurring trigger."""

import datetime as dt
import os

from pyspark.sql import functions as F

from mailframe.operators import store as st
from mailframe.operators.store import MailStore
from mailframe.streaming.poll import LANDING_SCHEMA, start_poll


def _rows(spark, items):
    return spark.createDataFrame(items, "folder_uri string, uid bigint, flaghashcode int")


def test_latest_version_and_seq_win(spark):
    a = st.initial_load(_rows(spark, [("f", 1, 1), ("f", 2, 1)]), version=0)
    b = st.initial_load(_rows(spark, [("f", 1, 9)]), version=1)
    d = st.delete_keys(_rows(spark, [("f", 2, 0)]), version=1)
    view = {r.uid: r.flaghashcode for r in st.current_view(st.union_log(a, b, d)).collect()}
    assert view == {1: 9}


def test_clear_hides_only_older_rows(spark):
    a = st.initial_load(_rows(spark, [("f", 1, 1), ("g", 1, 1)]), version=0)
    c = st.clear_folders(spark.createDataFrame([("f",)], "folder_uri string"), version=1, seq=0)
    b = st.initial_load(_rows(spark, [("f", 5, 1)]), version=1)  # same version, later seq
    view = sorted((r.folder_uri, r.uid) for r in st.current_view(st.union_log(a, c, b)).collect())
    assert view == [("f", 5), ("g", 1)]


def test_append_is_idempotent_per_version_and_compaction_keeps_view(spark, scratch):
    ms = MailStore(spark, os.path.join(scratch, "store"))
    ms.append(st.initial_load(_rows(spark, [("f", 1, 1), ("f", 2, 1)]), version=0))
    ms.append(st.initial_load(_rows(spark, [("f", 3, 1)]), version=1))
    ms.append(st.initial_load(_rows(spark, [("f", 3, 1)]), version=1))  # replayed batch
    ms.append(st.delete_keys(_rows(spark, [("f", 1, 0)]), version=2))
    before = sorted(r.uid for r in ms.view().collect())
    assert before == [2, 3]
    ms.compact(upto_version=2)
    assert sorted(r.uid for r in ms.view().collect()) == before
    assert ms.log().filter(F.col("op") == "delete").count() == 0
    again = MailStore(spark, os.path.join(scratch, "store"))  # a new reader follows the compacted log
    assert again.log_path == ms.log_path and sorted(r.uid for r in again.view().collect()) == before
    assert again.log_path.endswith("log-c2")
    ms.append(st.initial_load(_rows(spark, [("f", 9, 1)]), version=3))  # writers follow it too
    assert sorted(r.uid for r in again.view().collect()) == [2, 3, 9]


def test_poll_reads_only_buckets_of_polled_folders(spark, scratch):
    from mailframe.operators.store import folder_bucket
    from mailframe.streaming.poll import PollJob

    ms = MailStore(spark, os.path.join(scratch, "store"))
    rows = [(f"imap://a@x/F{i}", u, 0) for i in range(40) for u in range(1, 4)]
    ms.append(st.initial_load(_rows(spark, rows), version=0))
    folders = spark.createDataFrame([("imap://a@x/F3",)], "folder_uri string")
    view, _ = PollJob(spark, ms)._prior(1, folders)
    plan = view._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "/log" in ln][0]
    assert "fbucket" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0], scan
    assert sorted(r.uid for r in view.collect()) == [1, 2, 3]
    n_buckets = spark.createDataFrame(rows, "folder_uri string, uid bigint, h int") \
        .select(folder_bucket()).distinct().count()
    assert n_buckets > 1


def test_error_sink_last_error_wins(spark, scratch):
    ms = MailStore(spark, os.path.join(scratch, "store"))
    e = "message_id string, folder_uri string, error_msg string"
    ms.append_errors(spark.createDataFrame([("m1", "f", "first"), ("m2", "f", "x")], e), version=0)
    ms.append_errors(spark.createDataFrame([("m1", "f", "second")], e), version=1)
    got = {r.message_id: r.error_msg for r in ms.errors().collect()}
    assert got == {"m1": "second", "m2": "x"}


def test_processing_time_trigger(spark, scratch):
    landing = os.path.join(scratch, "landing")
    ms = MailStore(spark, os.path.join(scratch, "store"))
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a@x", "INBOX", "imap://a@x/INBOX", u, None, None, 0, t0, 1) for u in range(1, 6)]
    spark.createDataFrame(rows, LANDING_SCHEMA).coalesce(1).write.parquet(landing)
    q = start_poll(spark, landing, ms, interval="1 second", checkpoint=os.path.join(scratch, "ckpt"), name="recurring")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert ms.view().count() == 5


def test_create_if_absent_never_alters(spark, scratch):
    from pyspark.sql import types as T

    ms = MailStore(spark, os.path.join(scratch, "store"))
    custom = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("subject", T.StringType())])
    assert ms.create_if_absent(custom)
    assert not ms.create_if_absent()  # present: left as it is
    cols = set(ms.log().columns)
    assert {"doc_id", "subject", "op", "seq", "version", "folder_uri"} <= cols and "textContent" not in cols
    assert ms.view().count() == 0


def test_flag_rows_merge_onto_latest_document(spark):
    base = st.initial_load(_rows(spark, [("f", 1, 1), ("f", 2, 1), ("f", 3, 1)]), version=0)
    flags = _rows(spark, [("f", 1, 7), ("f", 2, 7), ("f", 3, 7)]).withColumn("op", F.lit("flags")) \
        .withColumn("version", F.lit(1).cast("bigint")).withColumn("seq", F.lit(1))
    flags = st.with_doc_id(flags)
    later = st.initial_load(_rows(spark, [("f", 2, 9)]), version=2)  # rewritten after the flags
    gone = st.delete_keys(_rows(spark, [("f", 3, 0)]), version=2)
    view = {r.uid: r.flaghashcode for r in st.current_view(st.union_log(base, flags, later, gone)).collect()}
    assert view == {1: 7, 2: 9}


def test_retry_errors_stores_fixed_messages(spark, scratch):
    ms = MailStore(spark, os.path.join(scratch, "store"))
    e = "message_id string, folder_uri string, error_msg string"
    ms.append_errors(spark.createDataFrame([("1::f", "f", "boom"), ("2::f", "f", "boom")], e), version=0)
    deep = b"Content-Type: multipart/mixed; boundary=b0\r\n\r\n" + b"".join(
        f"--b{i}\r\nContent-Type: multipart/mixed; boundary=b{i + 1}\r\n\r\n".encode() for i in range(101))
    raw = spark.createDataFrame([("f", 1, b"Subject: ok now\r\n\r\nhi\r\n"), ("f", 2, deep)],
                                "folder_uri string, uid bigint, raw binary")
    assert ms.retry_errors(raw, version=1) == 1
    assert [r.subject for r in ms.view().collect()] == ["ok now"]
    assert [r.message_id for r in ms.errors().collect()] == ["2::f"]


def test_errors_of_a_store_without_any(spark, scratch):
    assert MailStore(spark, os.path.join(scratch, "store")).errors().count() == 0


def test_retry_pop_messages_by_their_own_key(spark, scratch):
    ms = MailStore(spark, os.path.join(scratch, "store"))
    e = "message_id string, folder_uri string, error_msg string, uid bigint, pop_id string, kind string"
    ms.append_errors(spark.createDataFrame([("U7::f", "f", "boom", None, "U7", "parse"), ("7::f", "f", "boom", None, "7", "parse")], e), version=0)
    raw = spark.createDataFrame([("f", "U7", b"Subject: a\r\n\r\nx\r\n")], "folder_uri string, pop_id string, raw binary")
    assert ms.retry_errors(raw, version=1) == 1
    assert [r.doc_id for r in ms.view().collect()] == ["U7::f"]
    assert [r.kind for r in ms.errors().collect()] == ["missing"]


def test_later_columns_are_kept(spark, scratch):
    ms = MailStore(spark, os.path.join(scratch, "store"))
    ms.append(st.initial_load(spark.createDataFrame([("f", 1)], "folder_uri string, uid bigint"), 0))
    ms.append(st.initial_load(spark.createDataFrame([("f", 2, "s")], "folder_uri string, uid bigint, subject string"), 1))
    assert {r.uid: r.subject for r in ms.view("f").collect()} == {1: None, 2: "s"}


def test_view_plan_reads_filters_and_keeps_bodies_out_of_aggregates(spark, scratch):
    ms = MailStore(spark, os.path.join(scratch, "store"))
    rows = spark.createDataFrame([("f", 1, "body"), ("g", 2, "body")], "folder_uri string, uid bigint, textContent string")
    ms.append(st.initial_load(rows, 0))
    plan = ms.view().filter("folder_uri = 'f'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(folder_uri,f)" in plan
    assert not [x for x in plan.splitlines() if ("Aggregate" in x or " Sort " in x) and "textContent" in x]
    assert "PartitionFilters: [isnotnull(fbucket" in ms.view("f")._jdf.queryExecution().executedPlan().toString()


def test_view_broadcasts_no_side_that_grows_with_the_store(spark, scratch):
    ms = MailStore(spark, os.path.join(scratch, "store"))
    ms.create_if_absent()  # wide and mostly null: the planner takes the rows for smaller than they are
    ms.append(st.initial_load(_rows(spark, [("f", i, 1) for i in range(50)]), 0))
    flags = st.with_doc_id(_rows(spark, [("f", 7, 9)])).withColumns({"op": F.lit("flags"), "version": F.lit(1).cast("bigint"), "seq": F.lit(1)})
    ms.append(flags)
    view = ms.view()
    plan = view._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "BroadcastHashJoin" in x]
    assert all("folder_uri" in x for x in joins), joins  # one row per cleared folder
    assert {r.uid: r.flaghashcode for r in view.collect()} == {i: 9 if i == 7 else 1 for i in range(50)}
