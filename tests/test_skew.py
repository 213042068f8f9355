"""Hot-key behaviour: one folder holding most rows, checked against brute force."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from mailframe.operators import store as st
from mailframe.operators import sync
from mailframe.operators.numbering import number_within_group


def _listing(spark, seed=7):
    rnd = random.Random(seed)
    rows = []
    for u in rnd.sample(range(1, 50_000), 6_000):  # hot folder: most rows, sparse uids
        rows.append(("hot", u, rnd.randrange(64)))
    for f in ("a", "b", "c"):
        for u in rnd.sample(range(1, 500), 100):
            rows.append((f, u, rnd.randrange(64)))
    return rows


def test_numbering_hot_folder_matches_rank(spark):
    rows = _listing(spark)
    df = spark.createDataFrame(rows, "folder_uri string, uid bigint, flaghashcode int")
    got = number_within_group(df, ["folder_uri"], "uid", "n", bucket_width=256)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("folder_uri").orderBy("uid")))
    assert got.select("folder_uri", "uid", "n").exceptAll(want.select("folder_uri", "uid", "n")).count() == 0
    assert got.count() == len(rows)


def test_poll_with_hot_folder_matches_brute_force(spark):
    rnd = random.Random(11)
    server_rows = _listing(spark)
    stored_rows = [(f, u, h if rnd.random() < 0.8 else (h + 1) % 64) for f, u, h in server_rows if rnd.random() < 0.7]
    stored_rows += [("hot", u, 0) for u in range(60_000, 60_050)]  # gone from the server
    schema = "folder_uri string, uid bigint, flaghashcode int"
    listing = spark.createDataFrame(server_rows, schema)
    stored = st.with_doc_id(spark.createDataFrame(stored_rows, schema))
    folders = listing.select("folder_uri").distinct().withColumn("uid_validity", F.lit(1).cast("bigint"))
    state = sync.folder_marks(stored).withColumn("uid_validity", F.lit(1).cast("bigint"))
    changes = sync.imap_poll(stored, listing, folders, state, version=1).collect()

    # brute force
    s_map = {(f, u): h for f, u, h in stored_rows}
    marks = {}
    for f, u, _ in stored_rows:
        marks[f] = max(marks.get(f, 0), u)
    want_flags = {(f, u) for f, u, h in server_rows if (f, u) in s_map and s_map[(f, u)] != h}
    want_new = {(f, u) for f, u, _ in server_rows if u > marks.get(f, 0)}
    listed = {(f, u) for f, u, _ in server_rows}
    want_del = {k for k in s_map if k not in listed}

    got = {}
    for r in changes:
        got.setdefault((r.op, r.seq), set()).add((r.folder_uri, r.uid))
    assert got.get((sync.OP_FLAGS, sync.SEQ_FLAGS), set()) == want_flags
    assert got.get(("upsert", sync.SEQ_NEW), set()) == want_new
    assert got.get(("delete", sync.SEQ_DELETE), set()) == want_del
    assert ("clear", sync.SEQ_CLEAR) not in got
