"""Polls in odd orders and their bookkeeping: snapshot admission, repeats, bounded state, raw fetch, lookups, routing."""

import os

import pytest
from pyspark.sql import functions as F

from mailframe.operators import search
from mailframe.operators import store as st
from mailframe.operators import sync
from mailframe.operators.documents import fetch_documents, fetch_raw
from mailframe.operators.store import MailStore
from mailframe.options import MailOptions
from mailframe.streaming.poll import SNAPSHOT_SCHEMA, PollJob

A, B = "a@x", "b@x"


def uri(account, folder="INBOX"):
    return f"imap://{account}/{folder}"


def rows_of(account, snapshot, uids, folder="INBOX", validity=1, pop=False):
    """Rows of one folder: its marker row and its messages."""
    out = [(account, folder, uri(account, folder), None, None, None, None, None, validity, None, snapshot, None)]
    for n, u in enumerate(uids, 1):
        out.append((account, folder, uri(account, folder), None if pop else u, f"U{u}" if pop else None, n if pop else None, u % 8, None, validity, None, snapshot, None))
    return out


def end(account, snapshot, n):
    return (account, None, None, None, None, None, None, None, None, None, snapshot, n)


@pytest.fixture
def polls(spark, scratch):
    class Polls:
        store = MailStore(spark, os.path.join(scratch, "store"))
        n = 0

        def __init__(self, **more):
            self.job = PollJob(spark, self.store, **more)

        def batch(self, rows, n=None):
            self.job(spark.createDataFrame(rows, SNAPSHOT_SCHEMA).repartition(2), self.n if n is None else n)
            self.n += n is None
            return self.held()

        def whole(self, account, snapshot, uids, **more):
            rows = rows_of(account, snapshot, uids, **more)
            return self.batch([*rows, end(account, snapshot, len(rows))])

        def held(self):
            return sorted((r.pop_id or r.uid) for r in self.store.view().collect()) if self.store.exists() else []

    return Polls


def test_an_older_snapshot_that_is_complete_late_changes_nothing(polls):
    p = polls()
    assert p.whole(A, 0, [1, 2, 3]) == [1, 2, 3]
    early = rows_of(A, 1, [1, 2, 3, 4])
    assert p.batch(early) == [1, 2, 3]
    assert p.whole(A, 2, range(1, 7)) == [1, 2, 3, 4, 5, 6]
    assert p.batch([end(A, 1, len(early))]) == [1, 2, 3, 4, 5, 6]
    assert p.whole(A, 3, range(1, 8)) == [1, 2, 3, 4, 5, 6, 7]
    state = p.store.snapshots_before(None).collect()
    assert [(r.account, r.snapshot_id, r.applied) for r in state] == [(A, 3, True)]


def test_a_snapshot_in_pieces_with_copies_and_another_account_beside_it(polls):
    p = polls()
    rows = rows_of(A, 5, [1, 2, 3])
    assert p.batch(rows[:2] + rows[:1]) == []  # a copy does not make it complete
    assert p.batch([end(A, 5, 4), *rows[1:2]]) == []
    assert p.whole(B, 1, [11]) == [11]
    assert p.batch(rows[2:]) == [1, 2, 3, 11]
    assert p.whole(B, 1, [12, 13]) == [1, 2, 3, 11]  # not above the one applied
    assert p.whole(B, 2, [11, 12]) == [1, 2, 3, 11, 12]
    assert not os.listdir(p.store.landed_path) or {r.applied for r in p.store.snapshots_before(None).collect()} == {True}


def test_two_complete_snapshots_in_one_batch(polls):
    p = polls()
    rows = [*rows_of(A, 1, [1, 2]), end(A, 1, 3), *rows_of(A, 2, [2, 3]), end(A, 2, 3)]
    assert p.batch(rows) == [2, 3]


def test_a_complete_snapshot_without_a_folder_clears_its_account(polls):
    p = polls()
    p.whole(A, 0, [1, 2])
    assert p.whole(B, 0, [7]) == [1, 2, 7]
    assert p.batch([end(A, 1, 0)]) == [7]
    assert {r.folder_uri: r.exists for r in p.store.state().collect()} == {uri(A): False, uri(B): True}
    assert p.whole(A, 2, [1]) == [1, 7]


def test_a_repeat_after_compaction_changes_nothing(polls):
    p = polls()
    p.whole(A, 0, [1, 2, 3])
    rows = rows_of(A, 1, [1, 2, 3, 4])
    rows.append(end(A, 1, len(rows)))
    assert p.batch(rows) == [1, 2, 3, 4]
    p.store.compact(1)
    assert p.batch(rows, n=1) == [1, 2, 3, 4]
    assert p.store.log_path.endswith("log-c1")
    assert p.whole(A, 2, [2, 4, 5]) == [2, 4, 5]


def test_compaction_leaves_a_batch_that_has_not_ended(polls, monkeypatch):
    p = polls()
    p.whole(A, 0, [1, 2])
    rows = rows_of(A, 1, [2, 3])
    rows.append(end(A, 1, len(rows)))
    with monkeypatch.context() as m:
        m.setattr(MailStore, "write_state", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            p.batch(rows, n=1)
    assert not p.store.committed(1)
    p.store.compact(9)
    assert p.store.log_path.endswith("log-c0")
    assert p.batch(rows, n=1) == [2, 3]
    assert {r.folder_uri: r.last_uid for r in p.store.state().collect()} == {uri(A): 3}


def test_state_and_staging_stay_bounded(polls):
    p = polls()
    counts = []
    for i in range(12):
        p.whole(A, i, range(1, 3 + i))
        folders = [p.store.state_path, p.store.snapshots_path, p.store.landed_path, os.path.join(p.store.root, "_staging")]
        counts.append(sum(len(os.listdir(f)) for f in folders if os.path.exists(f)))
    assert p.held() == list(range(1, 14))
    assert counts[4:] == [counts[4]] * 8
    assert len(p.store.state_before(None).inputFiles()) <= 8  # one version, whatever came before


def test_counts_per_folder_and_poll(polls):
    p = polls()
    p.whole(A, 0, [1, 2, 3, 4])
    rows = [list(r) for r in rows_of(A, 1, [1, 3, 4, 5, 6])]
    rows[1][6] = 7  # other flags on message 1
    p.batch([*map(tuple, rows), tuple(rows[2]), end(A, 1, 6)])  # a landed copy counts once
    got = {(r.version, r.mode): (r.n_listed, r.n_new, r.n_flags, r.n_deleted, r.cleared) for r in p.store.metrics().collect()}
    assert got == {(0, "initial"): (4, 4, 0, 0, False), (1, "incremental"): (5, 2, 1, 1, False)}


def test_accounts_of_both_kinds_in_one_batch(spark, polls):
    table = [(A, "imaps"), (B, "pop3")]
    p = polls(accounts=lambda: spark.createDataFrame(table, "account string, protocol string"))
    rows = [*rows_of(A, None, [1, 2]), *rows_of(B, None, [1, 2], pop=True), *rows_of(B, None, [9], folder="Sent", pop=True), *rows_of("c@x", None, [5])]
    assert sorted(map(str, _mixed(p, rows))) == ["1", "2", "U1", "U2"]
    rows = [*rows_of(A, None, [2, 3]), *rows_of(B, None, [0, 2, 3], pop=True)]
    assert sorted(map(str, _mixed(p, rows))) == ["2", "3", "U0", "U2", "U3"]
    table.append(("c@x", ""))  # read anew by each poll; an empty protocol is IMAP
    assert sorted(map(str, _mixed(p, [*rows, *rows_of("c@x", None, [5])]))) == ["2", "3", "5", "U0", "U2", "U3"]


def _mixed(p, rows):
    p.job(p.job.spark.createDataFrame(rows, SNAPSHOT_SCHEMA), p.n)
    p.n += 1
    return [(r.pop_id or r.uid) for r in p.store.view().collect()]


def test_bodies_for_both_kinds(spark, scratch, polls):
    raw = [(uri(A), 1, None, b"Subject: imap one\r\n\r\nx"), (uri(B), None, "U1", b"Subject: pop one\r\n\r\ny")]
    path = os.path.join(scratch, "raw")
    spark.createDataFrame(raw, "folder_uri string, uid bigint, pop_id string, raw binary").write.parquet(path)
    p = polls(raw_path=path, accounts=spark.createDataFrame([(A, "imap"), (B, "pop3")], "account string, protocol string"))
    _mixed(p, [*rows_of(A, None, [1, 2]), *rows_of(B, None, [1, 2], pop=True)])
    assert sorted((r.doc_id, r.subject) for r in p.store.view().collect()) == [(f"1::{uri(A)}", "imap one"), (f"U1::{uri(B)}", "pop one")]
    assert sorted(r.message_id for r in p.store.errors().collect()) == [f"2::{uri(A)}", f"U2::{uri(B)}"]
    spark.createDataFrame([(uri(A), 2, None, b"Subject: late\r\n\r\nx")], "folder_uri string, uid bigint, pop_id string, raw binary").write.mode("append").parquet(path)
    _mixed(p, [*rows_of(A, None, [1, 2]), *rows_of(B, None, [1, 2], pop=True)])
    assert [r.message_id for r in p.store.errors().collect()] == [f"U2::{uri(B)}"]
    assert sorted(r.subject for r in p.store.view().collect()) == ["imap one", "late", "pop one"]


def test_few_new_messages_leave_the_raw_rows_where_they_lie(spark, scratch):
    path = os.path.join(scratch, "raw")
    raw = spark.range(20000).select(F.lit(uri(A)).alias("folder_uri"), F.col("id").alias("uid"), F.encode(F.repeat(F.lit("x"), 1000), "UTF-8").alias("raw"))
    raw.write.parquet(path)
    store = MailStore(spark, os.path.join(scratch, "store"))
    ups = store.stage(spark.createDataFrame([(uri(A), u, "upsert") for u in range(10)], "folder_uri string, uid bigint, op string"))
    found = fetch_raw(ups, spark.read.parquet(path), ["folder_uri", "uid"])
    assert found.count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    large = plan[plan.index("BroadcastHashJoin"):]
    assert "BuildRight" in large.splitlines()[0] and "raw" in large[: large.index("BroadcastExchange")]  # the raw side streams
    assert "SortMergeJoin" not in plan and plan.count("Exchange") == plan.count("BroadcastExchange")
    store.release()
    assert not os.listdir(os.path.join(store.root, "_staging"))


def test_a_lookup_reads_few_row_groups(spark, scratch):
    store = MailStore(spark, os.path.join(scratch, "store"))
    rows = spark.range(30000).select(F.lit("f").alias("folder_uri"), F.col("id").alias("uid"), F.lit(0).alias("flaghashcode"), F.sha2(F.col("id").cast("string"), 256).alias("subject"))
    block = spark.conf.get("parquet.block.size", None)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(64 << 10))
    try:
        store.append(st.initial_load(rows))
    finally:
        hadoop.unset("parquet.block.size") if block is None else hadoop.set("parquet.block.size", block)
    import pyarrow.parquet as pq

    files = [f.removeprefix("file:") for f in store.log().inputFiles()]
    groups = sum(pq.ParquetFile(f).num_row_groups for f in files)
    assert groups > 20
    one = store.log().filter(F.col("doc_id") == "777::f")
    assert [r.uid for r in one.collect()] == [777]
    scans = [x for x in _nodes(one._jdf.queryExecution().executedPlan()) if "Scan parquet" in x.nodeName()]
    assert scans[0].metrics().apply("numOutputRows").value() < 30000 / 4
    assert [r.uid for r in store.lookup(["777::f", "5::f", "none"]).orderBy("uid").collect()] == [5, 777]
    assert store.lookup(["none"]).count() == 0
    plan = store.lookup(["777::f"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [fbucket" in plan or "PartitionFilters: [isnotnull(fbucket" in plan


def _nodes(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    out, children = [plan], plan.children()
    for i in range(children.size()):
        out += _nodes(children.apply(i))
    return out


def test_a_lookup_sees_clears_flags_and_deletes(spark, scratch):
    store = MailStore(spark, os.path.join(scratch, "store"))
    schema = "folder_uri string, uid bigint, flaghashcode int"
    store.append(st.initial_load(spark.createDataFrame([("f", 1, 1), ("f", 2, 1), ("g", 3, 1), ("h", 4, 1)], schema)))
    flags = st.with_doc_id(spark.createDataFrame([("f", 2, 6)], schema)).withColumns({"op": F.lit("flags"), "version": F.lit(1).cast("bigint"), "seq": F.lit(1)})
    clear = st.clear_folders(spark.createDataFrame([("g",)], "folder_uri string"), version=1)
    gone = st.delete_keys(spark.createDataFrame([("f", 1, 0)], schema), version=1)
    store.append(st.union_log(flags, clear, gone))
    assert [(r.uid, r.flaghashcode) for r in store.lookup(["1::f", "2::f", "3::g", "4::h"]).orderBy("uid").collect()] == [(2, 6), (4, 1)]


def test_target_tables_are_partitions(spark, scratch):
    store = MailStore(spark, os.path.join(scratch, "store"))
    rows = [("f", 1, "one", "mail"), ("g", 2, "two", "mail"), ("h", 3, "two", "note"), ("i", 4, None, None)]
    store.append(st.initial_load(spark.createDataFrame(rows, "folder_uri string, uid bigint, index_name string, type_name string")))
    assert [r.uid for r in store.view(index_name="two", type_name="mail").collect()] == [2]
    assert sorted(r.uid for r in store.view().collect()) == [1, 2, 3, 4]
    plan = store.view(index_name="two")._jdf.queryExecution().executedPlan().toString()
    assert all("index_name" in x.split("PartitionFilters:")[1].split("PushedFilters")[0] for x in plan.splitlines() if "FileScan parquet" in x)
    names = spark.createDataFrame([("two", 1), ("one", 0)], "index_name string, wanted int").filter("wanted = 1")
    some = store.view(indexes=names)
    assert sorted(r.uid for r in some.collect()) == [2, 3]
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString()


def test_routing_reaches_clears_and_deletes(spark, polls):
    """Rows of every kind lie in their account's target table, so that it can be read alone."""
    p = polls(options=MailOptions(mail_index_name_strategy="username_crop"))
    p.whole(A, 0, [1, 2])
    p.whole(A, 1, [1, 2], folder="Sent")  # INBOX has gone
    p.whole(A, 2, [2], folder="Sent")
    assert [(r.uid, r.folder_uri) for r in p.store.view(index_name="a").collect()] == [(2, uri(A, "Sent"))]
    assert {r.index_name for r in p.store.log().select("index_name").distinct().collect()} == {"a"}


def test_conditions_on_one_element(spark):
    rows = [(1, [("x", "1"), ("y", "2")]), (2, [("x", "2")]), (3, []), (4, None), (5, [None]), (6, [(None, "2"), ("x", None)])]
    df = spark.createDataFrame(rows, "id int, to array<struct<email:string,personal:string>>")
    one = search.nested("to", lambda a: a["email"] == "x", lambda a: a["personal"] == "2")
    assert [r.id for r in df.filter(one).collect()] == [2]
    assert sorted(r.id for r in df.filter(search.nested("to")).collect()) == [1, 2, 6]
    assert df.filter(~one).count() == 5  # never null


def test_a_poll_sorts_each_side_once(spark):
    listing = spark.createDataFrame([(uri(A), 1, 5), (uri(A), 1, 5), (uri(A), 2, 5)], "folder_uri string, uid bigint, flaghashcode int")
    stored = spark.createDataFrame([(uri(A), 2, 4), (uri(A), 3, 4)], "folder_uri string, uid bigint, flaghashcode int")
    rules = spark.createDataFrame([(uri(A), "IMAP", "incremental", False, 0)], "folder_uri string, kind string, mode string, clear_first boolean, _mark bigint")
    log = st.initial_load(stored)
    changes = sync.poll_changes(st.narrow_view(log), listing, rules, 1)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [doc_id") == 2, plan  # nothing is sorted before its shuffle, and the join sorts nothing again
    assert sorted((r.doc_id.split(":")[0], r.op) for r in changes.collect()) == [("1", "upsert"), ("2", "upsert"), ("3", "delete")]


def test_raw_rows_of_one_file_are_parsed_in_many_tasks(spark, scratch):
    path = os.path.join(scratch, "raw")
    raw = spark.range(40).select(F.lit(uri(A)).alias("folder_uri"), F.col("id").alias("uid"), F.encode(F.lit("Subject: x\r\n\r\ny"), "UTF-8").alias("raw"))
    raw.coalesce(1).write.parquet(path)
    store, plans = MailStore(spark, os.path.join(scratch, "store")), []
    ups = spark.range(40).select(F.lit(uri(A)).alias("folder_uri"), F.col("id").alias("uid"), F.lit("upsert").alias("op"))

    def stage(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store.stage(df)

    docs, errors = fetch_documents(ups, spark.read.parquet(path), keys=["folder_uri", "uid"], stage=stage)
    assert docs.filter("subject = 'x'").count() == 40 and errors.count() == 0
    parse = plans[1][plans[1].index("MapInPandas"):]
    assert "REPARTITION_BY_NUM" in parse.split("Join")[0]  # between the raw rows and the parser
