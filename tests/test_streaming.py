"""Count scenarios of the reference's end-to-end tests, replayed as streaming polls."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from mailframe.operators import sync
from mailframe.operators.parse import RECURSION_ERROR
from mailframe.operators.store import MailStore
from mailframe.streaming.poll import LANDING_SCHEMA, start_poll

FOLDERS = ["INBOX", "Projects", "Projects/Level(2!"]
ACCOUNT = "reader@localhost"


def _uri(folder):
    return f"imap://reader%40localhost@localhost/{folder}"


def _uri_of(account, folder):
    user, host = account.split("@")
    return f"imap://{user}%40{host}@localhost/{folder}"


def _snapshot(spark, holdings, validity=1, account=ACCOUNT, pop=False):
    """holdings: {folder: [uids]} -> listing rows, plus one marker row per folder.

    POP rows carry the UIDL 'U<uid>' and the positional message number instead of a UID."""
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for folder, uids in holdings.items():
        uri = _uri_of(account, folder)
        rows.append((account, folder, uri, None, None, None, None, None, validity))
        for n, u in enumerate(sorted(uids), start=1):
            if pop:
                rows.append((account, folder, uri, None, f"U{u}", n, 0, t0 + dt.timedelta(minutes=u), None))
            else:
                rows.append((account, folder, uri, u, None, None, u % 64, t0 + dt.timedelta(minutes=u), validity))
    return spark.createDataFrame(rows, LANDING_SCHEMA)


class Scenario:
    def __init__(self, spark, root, switches=sync.PollSwitches(), pop=False, options=None):
        self.spark = spark
        self.landing = os.path.join(root, "landing")
        self.store = MailStore(spark, os.path.join(root, "store"))
        self.ckpt = os.path.join(root, "ckpt")
        self.switches = switches
        self.pop = pop
        self.options = options
        self.n = 0

    def land(self, holdings, validity=1, account=ACCOUNT):
        _snapshot(self.spark, holdings, validity, account, self.pop).coalesce(1).write.mode("append") \
            .parquet(self.landing)

    def run(self):
        q = start_poll(self.spark, self.landing, self.store, once=True, switches=self.switches,
                       checkpoint=self.ckpt, name=f"poll{id(self)}_{self.n}", pop=self.pop, options=self.options)
        self.n += 1
        q.awaitTermination(300)
        return self.store.view().count()

    def poll(self, holdings, validity=1):
        self.land(holdings, validity)
        q = start_poll(self.spark, self.landing, self.store, once=True, switches=self.switches,
                       checkpoint=self.ckpt, name=f"poll{id(self)}_{self.n}", pop=self.pop, options=self.options)
        self.n += 1
        q.awaitTermination(300)
        return self.store.view().count()


def test_delete_scenario_expunge_on(spark, scratch):
    s = Scenario(spark, scratch)
    h = {f: list(range(1, 12)) for f in FOLDERS}
    assert s.poll(h) == 33
    h["INBOX"] = [u for u in h["INBOX"] if u not in (2, 5, 7)]
    assert s.poll(h) == 30
    for f in FOLDERS:
        h[f] = h[f] + list(range(12, 19))
    assert s.poll(h) == 51
    h["INBOX"] = [u for u in h["INBOX"] if u not in (12, 13)]
    assert s.poll(h) == 49


def test_delete_scenario_keep_expunged(spark, scratch):
    s = Scenario(spark, scratch, sync.PollSwitches(delete_expunged=False))
    h = {f: list(range(1, 12)) for f in FOLDERS}
    assert s.poll(h) == 33
    h["INBOX"] = [u for u in h["INBOX"] if u not in (2, 5, 7)]
    assert s.poll(h) == 33
    for f in FOLDERS:
        h[f] = h[f] + list(range(12, 19))
    assert s.poll(h) == 54
    h["INBOX"] = [u for u in h["INBOX"] if u not in (12, 13)]
    assert s.poll(h) == 54


def test_rename_folder(spark, scratch):
    s = Scenario(spark, scratch)
    h = {f: list(range(1, 11)) for f in FOLDERS}
    assert s.poll(h) == 30
    # rename the subtree Projects -> renamed, then delete 2 messages
    h2 = {"INBOX": h["INBOX"][2:]}
    for f in FOLDERS[1:]:
        h2[f.replace("Projects", "renamed")] = h[f]
    assert s.poll(h2) == 28
    state = s.store.state().collect()
    gone = {r.folder_uri for r in state if not r.exists}
    assert gone == {_uri(f) for f in FOLDERS[1:]}


def test_replay_and_empty_polls_change_nothing(spark, scratch):
    s = Scenario(spark, scratch)
    h = {"INBOX": list(range(1, 51))}
    assert s.poll(h) == 50
    assert s.poll(h) == 50  # same snapshot again: idempotent
    h["INBOX"] += list(range(51, 56))
    assert s.poll(h) == 55
    st = {r.folder_uri: r for r in s.store.state().collect()}[_uri("INBOX")]
    assert st.last_uid == 55 and st.last_count == 5 and st.exists


def test_uid_validity_change_resyncs(spark, scratch):
    s = Scenario(spark, scratch)
    assert s.poll({"INBOX": list(range(1, 11))}, validity=1) == 10
    # server renumbered the folder: new validity, different UIDs
    assert s.poll({"INBOX": list(range(100, 105))}, validity=2) == 5
    view = s.store.view()
    assert sorted(r.uid for r in view.select("uid").collect()) == list(range(100, 105))


def test_empty_folder_listing_deletes_all(spark, scratch):
    s = Scenario(spark, scratch)
    assert s.poll({"INBOX": list(range(1, 6)), "Sent": [1, 2]}) == 7
    assert s.poll({"INBOX": [], "Sent": [1, 2]}) == 2


def test_poll_with_bodies_parses_and_records_errors(spark, scratch):
    """New and flag-changed messages are fetched from raw landing, parsed, stored; bad ones -> errors."""
    from email.mime.multipart import MIMEMultipart
    from email.mime.text import MIMEText

    def raw_msg(u):
        if u == 4:  # nests too deep: error row, not stored
            inner = MIMEText("deep", "plain")
            for _ in range(101):
                m = MIMEMultipart("mixed")
                m.attach(inner)
                inner = m
            return inner.as_bytes()
        m = MIMEText(f"<p>body {u}</p>", "plain")
        m["Subject"] = f"m{u}"
        return m.as_bytes()

    raw_path = os.path.join(scratch, "raw")
    spark.createDataFrame([(_uri("INBOX"), u, raw_msg(u)) for u in range(1, 8)],
                          "folder_uri string, uid bigint, raw binary").write.parquet(raw_path)
    s = Scenario(spark, scratch)
    landing_rows = {"INBOX": list(range(1, 6))}
    _snapshot(spark, landing_rows).coalesce(1).write.mode("append").parquet(s.landing)
    q = start_poll(spark, s.landing, s.store, once=True, checkpoint=s.ckpt, name="bodies1", raw_path=raw_path)
    q.awaitTermination(300)
    view = {r.uid: (r.subject, r.textContent, r.index_name) for r in s.store.view().collect()}
    assert view == {u: (f"m{u}", f"body {u}", "imapriverdata") for u in (1, 2, 3, 5)}
    errs = s.store.errors().collect()
    assert [(e.message_id, e.error_msg) for e in errs] == [(f"4::{_uri('INBOX')}", RECURSION_ERROR)]
    # second poll: 6, 7 new; 1 expunged
    _snapshot(spark, {"INBOX": [2, 3, 4, 5, 6, 7]}).coalesce(1).write.mode("append").parquet(s.landing)
    q = start_poll(spark, s.landing, s.store, once=True, checkpoint=s.ckpt, name="bodies2", raw_path=raw_path)
    q.awaitTermination(300)
    assert sorted(r.uid for r in s.store.view().collect()) == [2, 3, 5, 6, 7]



def test_mass_scenario(spark, scratch):
    s = Scenario(spark, scratch)
    assert s.poll({"INBOX": list(range(1, 51))}) == 50
    assert s.poll({"INBOX": list(range(1, 101))}) == 100


def test_pop_delete_scenario(spark, scratch):
    """POP: 10 put, 3 deleted, 5 put, 2 deleted -> 10 (reference counts)."""
    s = Scenario(spark, scratch, pop=True)
    held = list(range(1, 11))
    assert s.poll({"INBOX": held}) == 10
    held = [u for u in held if u not in (1, 4, 9)]
    assert s.poll({"INBOX": held}) == 7
    held += list(range(11, 16))
    assert s.poll({"INBOX": held}) == 12
    held = [u for u in held if u not in (2, 12)]
    assert s.poll({"INBOX": held}) == 10
    assert {r.doc_id.split("::")[0] for r in s.store.view().collect()} == {f"U{u}" for u in held}


def test_multi_account_routing(spark, scratch):
    """3 accounts, 50 + 5 messages each, username_crop: 165 rows over three index names."""
    from mailframe.options import MailOptions

    s = Scenario(spark, scratch, options=MailOptions(mail_index_name_strategy="username_crop"))
    accounts = [f"reader{i}@localhost" for i in ("", "2", "3")]
    for a in accounts:
        s.land({"INBOX": list(range(1, 51))}, account=a)
    assert s.run() == 150
    for a in accounts:
        s.land({"INBOX": list(range(1, 56))}, account=a)
    assert s.run() == 165
    counts = {r.index_name: r["count"] for r in s.store.view().groupBy("index_name").count().collect()}
    assert counts == {a.split("@")[0]: 55 for a in accounts}


def test_two_stores_each_keep_state(spark, scratch):
    a = Scenario(spark, os.path.join(scratch, "a"))
    b = Scenario(spark, os.path.join(scratch, "b"))
    assert a.poll({"INBOX": [1, 2, 3, 4, 5]}) == 5
    assert b.poll({"INBOX": [1, 2, 3, 4, 5]}) == 5
    assert a.store.state().count() == 1 and b.store.state().count() == 1


def test_state_untouched_when_nothing_new(spark, scratch):
    s = Scenario(spark, scratch)
    assert s.poll({"INBOX": [1, 2, 3]}) == 3
    before = s.store.state().first()
    assert s.poll({"INBOX": [1, 2, 3]}) == 3
    after = s.store.state().first()
    assert (after.last_uid, after.last_count, after.last_schedule) == (before.last_uid, before.last_count,
                                                                       before.last_schedule)
    assert s.poll({"INBOX": [1, 2, 3], "Empty": []}) == 3  # full load of an empty folder: count 0
    empty = [r for r in s.store.state().collect() if r.folder_uri.endswith("/Empty")][0]
    assert empty.last_count == 0 and empty.last_uid == -1


def test_new_stream_on_existing_store_keeps_its_versions(spark, scratch):
    s = Scenario(spark, scratch)
    assert s.poll({"INBOX": [1, 2, 3]}) == 3
    assert s.poll({"INBOX": [1, 2, 3, 4]}) == 4
    # a second stream (own landing and checkpoint) on the same store and account
    t = Scenario(spark, os.path.join(scratch, "second"))
    t.store = s.store
    assert t.poll({"INBOX": [1, 2, 3, 4, 5]}) == 5
    versions = sorted({r.version for r in s.store.log().select("version").distinct().collect()})
    assert versions == [0, 1, 2]


def test_one_file_per_poll(spark, scratch):
    import time

    s = Scenario(spark, scratch)
    s.land({"INBOX": list(range(1, 11))})
    time.sleep(1.1)  # landing order = modification-time order
    s.land({"INBOX": list(range(3, 16))})
    q = start_poll(spark, s.landing, s.store, once=True, checkpoint=s.ckpt, name="per-file", files_per_batch=1)
    q.awaitTermination(300)
    assert sorted(r.uid for r in s.store.view().collect()) == list(range(3, 16))
    assert sorted(r.version for r in s.store.log().select("version").distinct().collect()) == [0, 1]


def test_folder_pattern_in_polls(spark, scratch):
    """Only matching folders are polled; a non-matching holding folder hides its subtree;
    folders left out by the pattern are not treated as vanished."""
    from mailframe.options import MailOptions

    s = Scenario(spark, scratch)
    h = {"INBOX": [1, 2], "Archive": [1], "Archive/2024": [1, 2, 3], "Lists": [1]}
    assert s.poll(h) == 7
    s.options = MailOptions(folderpattern="INBOX|Archive/.*|Lists")
    h["INBOX"] = [1, 2, 3]
    h["Archive/2024"] = [1]  # inside the pruned subtree: not polled, nothing deleted
    h["Lists"] = [1, 2]
    assert s.poll(h) == 9  # INBOX +1, Lists +1; Archive and its subtree untouched


def test_usage_flow_with_created_table(spark, scratch):
    """README usage: create the table first (fixed schema), poll with bodies and options, search the view."""
    from email.mime.text import MIMEText

    from mailframe.operators import search
    from mailframe.options import MailOptions

    def raw_msg(u):
        m = MIMEText(f"body {u}", "plain")
        m["Subject"] = f"s{u}"
        m["Message-ID"] = f"<{u}@x>"
        return m.as_bytes()

    raw_path = os.path.join(scratch, "raw")
    spark.createDataFrame([(_uri("INBOX"), u, raw_msg(u)) for u in range(1, 6)],
                          "folder_uri string, uid bigint, raw binary").write.parquet(raw_path)
    opts = MailOptions.from_settings({"folderpattern": "INBOX", "headers_to_fields": ["Message-ID"],
                                      "mail_index_name_strategy": "username_crop"})
    s = Scenario(spark, scratch, options=opts)
    assert s.store.create_if_absent()
    s.land({"INBOX": [1, 2, 3, 4, 5], "Other": [1]})
    q = start_poll(spark, s.landing, s.store, once=True, checkpoint=s.ckpt, name="usage", options=opts,
                   raw_path=raw_path)
    q.awaitTermination(300)
    view = s.store.view()
    hits = search.bool_must(view, search.term("folder_uri", _uri("INBOX")), search.terms("uid", [2, 3]))
    assert sorted((r.subject, r.index_name) for r in hits.collect()) == [("s2", "reader"),
                                                                         ("s3", "reader")]
    assert view.count() == 5  # "Other" does not match the pattern
