"""Synchronisation queries Q08 and Q10-Q16 on the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailframe.functions.keys import doc_id, state_id
from mailframe.operators import store, sync
from mailframe.operators.search import distinct_values
from mailframe.plans.registry import register
from mailframe.sources import fixtures as fx
from mailframe.sources.fixtures import with_views


@register("stored_folders", with_views("mailbox") + """
SELECT DISTINCT account AS index_name, folder_full_name FROM mailbox""")
def stored_folders(spark, sf_dir):
    """Q08 (S7, A3, F8): distinct stored folder names per index (index = account)."""
    rows = fx.mailbox(spark, sf_dir).select(F.col("account").alias("index_name"), "folder_full_name")
    return distinct_values(rows, "index_name", "folder_full_name")


@register("new_messages", with_views("stored", "server") + """,
marks AS (SELECT folder_uri, max(uid) AS last_uid FROM stored GROUP BY folder_uri)
SELECT s.folder_uri, s.uid, s.flaghashcode
FROM server s LEFT JOIN marks m ON s.folder_uri = m.folder_uri
WHERE s.uid > coalesce(m.last_uid, 0)""")
def new_messages(spark, sf_dir):
    """Q10 (S2, Y2): server messages above each folder's stored high-water mark."""
    state = sync.folder_marks(fx.stored(spark, sf_dir))
    listing = fx.server(spark, sf_dir).select("folder_uri", "uid", "flaghashcode")
    return sync.new_messages(listing, state)


@register("last_listed_message", with_views("server") + """
SELECT folder_uri, max(uid) AS last_uid, arg_max(flaghashcode, uid) AS last_flaghashcode, count(*) AS n_listed
FROM server GROUP BY folder_uri""")
def last_listed_message(spark, sf_dir):
    """L2: the last message of each folder listing (max_by over a partial aggregate)."""
    return fx.server(spark, sf_dir).groupBy("folder_uri").agg(
        F.max("uid").alias("last_uid"),
        F.max_by("flaghashcode", "uid").alias("last_flaghashcode"),
        F.count(F.lit(1)).alias("n_listed"),
    )


@register("flag_changes", with_views("stored", "server") + """
SELECT s.folder_uri, s.uid, s.flaghashcode, t.flaghashcode AS old_flaghashcode
FROM server s JOIN stored t ON s.folder_uri = t.folder_uri AND s.uid = t.uid
WHERE s.flaghashcode <> t.flaghashcode""")
def flag_changes(spark, sf_dir):
    """Q11 (S8, Y3, F14): stored messages whose flags changed on the server."""
    listing = fx.server(spark, sf_dir).select("folder_uri", "uid", "flaghashcode")
    return sync.flag_changes(listing, fx.stored(spark, sf_dir))


@register("expunged_messages", with_views("stored", "server") + """
SELECT t.folder_uri, t.uid, CAST(t.uid AS VARCHAR) || '::' || t.folder_uri AS doc_id
FROM stored t ANTI JOIN server s ON t.folder_uri = s.folder_uri AND t.uid = s.uid
WHERE t.folder_uri IN (SELECT folder_uri FROM server)""")
def expunged_messages(spark, sf_dir):
    """Q12 (S6, Y4, Y12, K4): stored messages the server no longer lists."""
    listing = sync.distinct_listing(fx.server(spark, sf_dir).select("folder_uri", "uid"))
    gone = sync.expunged(fx.stored(spark, sf_dir).select("folder_uri", "uid"), listing)
    return gone.withColumn("doc_id", doc_id("uid", None, "folder_uri"))


@register("expunge_counts", with_views("stored", "server") + """,
gone AS (SELECT t.folder_uri FROM stored t ANTI JOIN server s ON t.folder_uri = s.folder_uri AND t.uid = s.uid),
st AS (SELECT folder_uri, count(*) AS n_stored FROM stored GROUP BY folder_uri),
ls AS (SELECT folder_uri, count(*) AS n_listed FROM server GROUP BY folder_uri),
dl AS (SELECT folder_uri, count(*) AS n_deleted FROM gone GROUP BY folder_uri)
SELECT ls.folder_uri, coalesce(st.n_stored, 0) AS n_stored, ls.n_listed, coalesce(dl.n_deleted, 0) AS n_deleted
FROM ls LEFT JOIN st ON ls.folder_uri = st.folder_uri LEFT JOIN dl ON ls.folder_uri = dl.folder_uri""")
def expunge_counts(spark, sf_dir):
    """Per-folder sizes of stored / listed / deleted sets for one poll."""
    stored = fx.stored(spark, sf_dir).select("folder_uri", "uid")
    listing = fx.server(spark, sf_dir).select("folder_uri", "uid")
    gone = sync.expunged(stored, listing)
    st = stored.groupBy("folder_uri").agg(F.count(F.lit(1)).alias("n_stored"))
    ls = listing.groupBy("folder_uri").agg(F.count(F.lit(1)).alias("n_listed"))
    dl = gone.groupBy("folder_uri").agg(F.count(F.lit(1)).alias("n_deleted"))
    return (
        ls.join(st, "folder_uri", "left").join(dl, "folder_uri", "left")
        .select("folder_uri", F.coalesce("n_stored", F.lit(0)).alias("n_stored"), "n_listed",
                F.coalesce("n_deleted", F.lit(0)).alias("n_deleted"))
    )


_JAVA_HASH_SQL = """CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER)"""


@register("folder_state", with_views("mailbox") + """,
agg AS (SELECT folder_uri, max(uid) AS last_uid, count(*) AS last_count FROM mailbox GROUP BY folder_uri),
hashed AS (SELECT *, list_reduce([0::BIGINT] || list_transform(string_split(folder_uri, ''), lambda c: ascii(c)::BIGINT),
                                 lambda a, x: (a * 31 + x) % 4294967296) AS h FROM agg)
SELECT folder_uri, true AS "exists", last_uid, last_count,
       'folderstate_' || CAST(""" + _JAVA_HASH_SQL + """ AS VARCHAR) AS state_id
FROM hashed""")
def folder_state(spark, sf_dir):
    """Q13 (S9, Y9, K7, P18, A4, A5): the state row per folder after loading ``mailbox``."""
    empty_state = spark.createDataFrame([], "folder_uri string, exists boolean, uid_validity bigint, "
                                            "last_uid bigint, last_count bigint, last_indexed timestamp")
    st = sync.state_advance(fx.mailbox(spark, sf_dir).select("folder_uri", "uid"), empty_state)
    return st.select("folder_uri", "exists", "last_uid", "last_count", state_id("folder_uri").alias("state_id"))


# Q14 fixture: the server renames one folder and reports UID validities; the
# stored state has one validity unknown (null) and one that changed.
RENAMED_ACCOUNT, RENAMED_FOLDER, RENAMED_TO = "user1@example.com", "signup", "archive/signup"


def _server_folders(spark, sf_dir):
    srv = fx.server(spark, sf_dir).select("account", "folder_full_name", "folder_uri").distinct()
    renamed = (F.col("account") == RENAMED_ACCOUNT) & (F.col("folder_full_name") == RENAMED_FOLDER)
    return srv.select(
        "account",
        F.when(renamed, F.lit(RENAMED_TO)).otherwise(F.col("folder_full_name")).alias("folder_full_name"),
        F.when(renamed, F.regexp_replace("folder_uri", RENAMED_FOLDER + "$", RENAMED_TO)).otherwise(F.col("folder_uri")).alias("folder_uri"),
    ).withColumn("uid_validity", F.length("folder_uri").cast("bigint"))


def _stored_state(spark, sf_dir):
    marks = sync.folder_marks(fx.stored(spark, sf_dir).select("folder_uri", "uid", "folder_full_name"))
    name = F.regexp_extract("folder_uri", "([^/]+)$", 1)
    return marks.withColumn(
        "uid_validity",
        F.when(name == "view", F.lit(None).cast("bigint"))
        .when(name == "error", F.length("folder_uri").cast("bigint") + 1)
        .otherwise(F.length("folder_uri").cast("bigint")),
    )


@register("resync_plan", with_views("stored", "server") + """,
sf AS (SELECT DISTINCT account, folder_full_name, folder_uri FROM server),
srv AS (SELECT CASE WHEN account = 'user1@example.com' AND folder_full_name = 'signup'
                    THEN regexp_replace(folder_uri, 'signup$', 'archive/signup') ELSE folder_uri END AS folder_uri
        FROM sf),
srv2 AS (SELECT folder_uri, CAST(length(folder_uri) AS BIGINT) AS new_validity FROM srv),
st AS (SELECT folder_uri,
              CASE regexp_extract(folder_uri, '([^/]+)$', 1) WHEN 'view' THEN NULL
                   WHEN 'error' THEN CAST(length(folder_uri) AS BIGINT) + 1
                   ELSE CAST(length(folder_uri) AS BIGINT) END AS old_validity
       FROM (SELECT DISTINCT folder_uri FROM stored)),
j AS (SELECT coalesce(srv2.folder_uri, st.folder_uri) AS folder_uri, srv2.folder_uri IS NOT NULL AS on_server,
             st.folder_uri IS NOT NULL AS in_state, old_validity, new_validity
      FROM srv2 FULL OUTER JOIN st ON srv2.folder_uri = st.folder_uri)
SELECT folder_uri,
       CASE WHEN NOT on_server THEN 'vanished' WHEN NOT in_state THEN 'initial'
            WHEN old_validity IS NULL OR old_validity IS DISTINCT FROM new_validity THEN 'resync'
            ELSE 'incremental' END AS mode,
       (NOT on_server) OR (in_state AND old_validity IS NOT NULL AND old_validity IS DISTINCT FROM new_validity) AS clear_first,
       old_validity, new_validity
FROM j""")
def resync_plan(spark, sf_dir):
    """Q14 (Y1, Y5, Y11, K5): poll mode per folder from UID validity and folder presence."""
    return sync.resync_plan(_server_folders(spark, sf_dir), _stored_state(spark, sf_dir))


@register("vanished_folders", with_views("stored", "server") + """,
sf AS (SELECT DISTINCT account, CASE WHEN account = 'user1@example.com' AND folder_full_name = 'signup'
                                     THEN 'archive/signup' ELSE folder_full_name END AS folder_full_name FROM server)
SELECT DISTINCT t.account, t.folder_full_name FROM stored t
WHERE NOT EXISTS (SELECT 1 FROM sf WHERE sf.account = t.account AND sf.folder_full_name = t.folder_full_name)""")
def vanished_folders(spark, sf_dir):
    """Stored folders that vanished from the server (per account)."""
    return sync.vanished_folders(fx.stored(spark, sf_dir), _server_folders(spark, sf_dir))


@register("pop_new", with_views("pop_server", "pop_stored") + """
SELECT s.folder_uri, s.pop_id, s.msg_num FROM pop_server s
ANTI JOIN pop_stored t ON s.folder_uri = t.folder_uri AND s.pop_id = t.pop_id""")
def pop_new(spark, sf_dir):
    """Q15 (S3, Y6): POP messages whose UIDL is not stored."""
    listing = fx.pop_server(spark, sf_dir).select("folder_uri", "pop_id", "msg_num")
    return sync.pop_new(listing, fx.pop_stored(spark, sf_dir))


@register("pop_new_by_number", with_views("pop_server", "pop_stored") + """,
top AS (SELECT s.folder_uri, max(s.msg_num) AS top FROM pop_server s
        SEMI JOIN pop_stored t ON s.folder_uri = t.folder_uri AND s.pop_id = t.pop_id GROUP BY s.folder_uri)
SELECT s.folder_uri, s.pop_id, s.msg_num FROM pop_server s LEFT JOIN top ON s.folder_uri = top.folder_uri
WHERE s.msg_num > coalesce(top.top, 0)""")
def pop_new_by_number(spark, sf_dir):
    """Q15 (Y6, L3): POP messages numbered above the highest stored number."""
    listing = fx.pop_server(spark, sf_dir).select("folder_uri", "pop_id", "msg_num")
    return sync.pop_new_by_number(listing, fx.pop_stored(spark, sf_dir))


@register("pop_expunged", with_views("pop_server", "pop_stored") + """
SELECT t.folder_uri, t.pop_id FROM pop_stored t
ANTI JOIN pop_server s ON t.folder_uri = s.folder_uri AND t.pop_id = s.pop_id
WHERE t.folder_uri IN (SELECT folder_uri FROM pop_server)""")
def pop_expunged(spark, sf_dir):
    """Q15 (Y7): stored POP messages no longer listed."""
    listing = fx.pop_server(spark, sf_dir).select("folder_uri", "pop_id")
    return sync.pop_expunged(fx.pop_stored(spark, sf_dir).select("folder_uri", "pop_id"), listing)


@register("pop_still_listed", with_views("pop_server", "pop_stored") + """
SELECT t.folder_uri, t.pop_id FROM pop_stored t
SEMI JOIN pop_server s ON t.folder_uri = s.folder_uri AND t.pop_id = s.pop_id""")
def pop_still_listed(spark, sf_dir):
    """Stored POP ids still on the server."""
    listing = fx.pop_server(spark, sf_dir).select("folder_uri", "pop_id")
    return sync.still_listed(fx.pop_stored(spark, sf_dir).select("folder_uri", "pop_id"), listing)


@register("pop_message_range", with_views("pop_server") + """
SELECT folder_uri, pop_id, msg_num FROM pop_server WHERE msg_num BETWEEN 100 AND 250""")
def pop_message_range(spark, sf_dir):
    """L3: message-number slice [start, end] of a POP listing."""
    return fx.pop_server(spark, sf_dir).select("folder_uri", "pop_id", "msg_num").filter(F.col("msg_num").between(100, 250))


_STORE_AFTER_POLL_SQL = with_views("stored", "server") + """,
marks AS (SELECT folder_uri, max(uid) AS last_uid FROM stored GROUP BY folder_uri)
SELECT CAST(s.uid AS VARCHAR) || '::' || s.folder_uri AS doc_id, s.folder_uri, s.uid, s.flaghashcode, s.received_date
FROM server s LEFT JOIN marks m ON s.folder_uri = m.folder_uri
WHERE s.uid > coalesce(m.last_uid, 0)
   OR EXISTS (SELECT 1 FROM stored t WHERE t.folder_uri = s.folder_uri AND t.uid = s.uid)"""


@register("store_after_poll", _STORE_AFTER_POLL_SQL)
def store_after_poll(spark, sf_dir):
    """Q16 (K1-K6, L4, L5, Y13): log = initial load of ``stored`` + one poll; result = current view."""
    cols = ["folder_uri", "uid", "flaghashcode", "received_date"]
    stored = fx.stored(spark, sf_dir).select(*cols)
    listing = fx.server(spark, sf_dir).select(*cols)
    folders = listing.select("folder_uri").distinct().withColumn("uid_validity", F.lit(1).cast("bigint"))
    state = sync.folder_marks(stored).withColumn("uid_validity", F.lit(1).cast("bigint"))
    log0 = store.initial_load(stored, version=0)
    # a log holding one initial load is its own current view: the stored rows
    view0 = store.with_doc_id(stored)
    changes = sync.imap_poll(view0, listing, folders, state, version=1)
    log = store.union_log(log0, store.as_log(changes))
    return store.current_view(log).select("doc_id", *cols)


@register("store_after_stream", _STORE_AFTER_POLL_SQL)
def store_after_stream(spark, sf_dir):
    """``stored`` then ``server`` land as two listing snapshots; two run-once polls
    of the streaming job build the store; result = its current view (same as Q16)."""
    import uuid

    from mailframe.operators.store import MailStore
    from mailframe.session import checkpoint_path
    from mailframe.streaming.poll import LANDING_SCHEMA, start_poll

    root = checkpoint_path(spark, f"store_after_stream-{uuid.uuid4().hex}")
    landing = f"{root}/landing"
    mail_store = MailStore(spark, f"{root}/store")

    def snapshot(df):
        rows = df.select("account", "folder_full_name", "folder_uri", "uid", "flaghashcode", "received_date")
        markers = rows.select("account", "folder_full_name", "folder_uri").distinct()
        full = rows.unionByName(markers, allowMissingColumns=True).withColumn("uid_validity", F.lit(1).cast("bigint"))
        return full.select(*[F.col(f.name).cast(f.dataType) if f.name in full.columns
                             else F.lit(None).cast(f.dataType).alias(f.name) for f in LANDING_SCHEMA.fields])

    for i, df in enumerate((fx.stored(spark, sf_dir), fx.server(spark, sf_dir))):
        snapshot(df).write.mode("append").parquet(landing)
        # one run-once stream per landed snapshot: the poll order is the landing order
        q = start_poll(spark, landing, mail_store, once=True, checkpoint=f"{root}/ckpt",
                       name=f"stream-{uuid.uuid4().hex[:8]}-{i}")
        if not q.awaitTermination(3600) or q.exception() is not None:
            q.stop()
            raise RuntimeError(f"poll {i} did not finish: {q.exception()}")
    return mail_store.view().select("doc_id", "folder_uri", "uid", "flaghashcode", "received_date")


def _landed(df, snapshot_id: int, complete: bool = True):
    """Rows of a landing snapshot: the messages, a row for each folder, and one that tells how many they are."""
    from mailframe.streaming.poll import SNAPSHOT_SCHEMA

    rows = df.select("account", "folder_full_name", "folder_uri", "uid", "flaghashcode", "received_date")
    markers = rows.select("account", "folder_full_name", "folder_uri").distinct()
    full = rows.unionByName(markers, allowMissingColumns=True).withColumn("uid_validity", F.lit(1).cast("bigint"))
    sizes = full.groupBy("account").agg(F.count(F.lit(1)).alias("snapshot_rows"))
    if not complete:
        full = full.filter(F.col("uid") % 2 == 0)
    full = full.unionByName(sizes, allowMissingColumns=True).withColumn("snapshot_id", F.lit(snapshot_id).cast("bigint"))
    return full.select(*[F.col(f.name).cast(f.dataType) if f.name in full.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in SNAPSHOT_SCHEMA.fields])


@register("store_after_split_snapshot", _STORE_AFTER_POLL_SQL)
def store_after_split_snapshot(spark, sf_dir):
    """Snapshots land as many files, several in one drain and split over batches, the
    last one incomplete; the store equals the latest complete one."""
    import uuid

    from mailframe.operators.store import MailStore
    from mailframe.session import checkpoint_path
    from mailframe.streaming.poll import start_poll

    root = checkpoint_path(spark, f"store_after_split_snapshot-{uuid.uuid4().hex}")
    landing = f"{root}/landing"
    mail_store = MailStore(spark, f"{root}/store")
    parts = [(fx.stored(spark, sf_dir), True), (fx.server(spark, sf_dir), True), (fx.stored(spark, sf_dir), False)]
    for i, (df, complete) in enumerate(parts):
        _landed(df, i, complete).repartition(3).write.mode("append").parquet(landing)
    q = start_poll(spark, landing, mail_store, once=True, checkpoint=f"{root}/ckpt", files_per_batch=5,
                   name=f"stream-{uuid.uuid4().hex[:8]}")
    if not q.awaitTermination(3600) or q.exception() is not None:
        q.stop()
        raise RuntimeError(f"the poll did not finish: {q.exception()}")
    return mail_store.view().select("doc_id", "folder_uri", "uid", "flaghashcode", "received_date")


@register("folder_vanish_return", with_views("server") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, folder_uri, uid, flaghashcode FROM server""")
def folder_vanish_return(spark, sf_dir):
    """A folder vanishes for two polls and comes back; it is loaded in full again."""
    import uuid

    from mailframe.operators.store import MailStore
    from mailframe.session import checkpoint_path
    from mailframe.streaming.poll import PollJob

    mail_store = MailStore(spark, checkpoint_path(spark, f"folder_vanish_return-{uuid.uuid4().hex}"))
    job = PollJob(spark, mail_store)
    listing = fx.server(spark, sf_dir)
    without = listing.filter(F.col("folder_full_name") != "click")
    for i, df in enumerate((listing, without, without, listing)):
        job(_landed(df, i), i)
    return mail_store.view().select("doc_id", "folder_uri", "uid", "flaghashcode")


@register("poll_with_bodies", """
SELECT CAST(doc_id AS VARCHAR) || '::imap://reader%40example.com@mail.example.com/' || lang AS doc_id,
       CASE WHEN doc_id % 13 = 0 THEN 'parse' ELSE 'stored' END AS status,
       CASE WHEN doc_id % 13 <> 0 THEN 'Über ' || doc_id || ' (' || lang || ')' END AS subject
FROM documents""")
def poll_with_bodies(spark, sf_dir):
    """K2, K8, P20: whole messages are fetched and parsed in the poll; a fifth of the raw bytes lands one
    poll late and is taken up then, messages that cannot be parsed are in the error table."""
    import uuid

    from mailframe.operators.store import MailStore, folder_bucket
    from mailframe.session import checkpoint_path
    from mailframe.sources.raw import raw_from_documents
    from mailframe.streaming.poll import PollJob

    root = checkpoint_path(spark, f"poll_with_bodies-{uuid.uuid4().hex}")
    raw = raw_from_documents(spark, sf_dir).select("folder_uri", F.col("message_id").cast("bigint").alias("uid"), "raw")
    raw = raw.withColumn("fbucket", folder_bucket())
    mail_store = MailStore(spark, f"{root}/store")
    job = PollJob(spark, mail_store, raw_path=f"{root}/raw")
    listing = raw.select(
        F.lit("reader@example.com").alias("account"), F.regexp_extract("folder_uri", "([^/]+)$", 1).alias("folder_full_name"),
        "folder_uri", "uid", (F.col("uid") % 64).cast("int").alias("flaghashcode"), F.lit(None).cast("timestamp_ntz").alias("received_date"),
    )
    late = F.col("uid") % 5 == 0
    for i, landed in enumerate((~late, late)):
        raw.filter(landed).write.mode("append").partitionBy("fbucket").parquet(f"{root}/raw")
        job(_landed(listing, i), i)
    stored = mail_store.view().select("doc_id", F.lit("stored").alias("status"), "subject")
    errors = mail_store.errors().select(F.col("message_id").alias("doc_id"), F.col("kind").alias("status"), F.lit(None).cast("string").alias("subject"))
    return stored.unionByName(errors)


DELETE_FROM_HASH = 48


@register("store_after_delete", with_views("mailbox") + f"""
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, folder_uri, uid, flaghashcode
FROM mailbox WHERE NOT (flaghashcode >= {DELETE_FROM_HASH} AND folder_full_name = 'click')""")
def store_after_delete(spark, sf_dir):
    """K6: delete by predicate in one pass (tombstones), then K5 is not involved; current view."""
    cols = ["folder_uri", "uid", "flaghashcode", "folder_full_name"]
    log0 = store.initial_load(fx.mailbox(spark, sf_dir).select(*cols), version=0)
    view0 = store.current_view(log0)
    pred = (F.col("flaghashcode") >= DELETE_FROM_HASH) & (F.col("folder_full_name") == "click")
    log = store.union_log(log0, store.delete_where(view0.select("doc_id", "folder_uri", "uid", "folder_full_name",
                                                                "flaghashcode"), pred, version=1))
    return store.current_view(log).select("doc_id", "folder_uri", "uid", "flaghashcode")


@register("store_after_clear", with_views("mailbox") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, folder_uri, uid
FROM mailbox WHERE folder_full_name <> 'signup' OR uid % 5 >= 2""")
def store_after_clear(spark, sf_dir):
    """K5: clearing folders hides every older row; rows written after the clear stay visible."""
    cols = ["folder_uri", "uid", "folder_full_name"]
    rows = fx.mailbox(spark, sf_dir).select(*cols)
    before = F.col("uid") % 5 < 2  # two fifths are stored before the clear
    early = store.initial_load(rows.filter(before), version=0)
    signup = rows.filter(F.col("folder_full_name") == "signup").select("folder_uri")
    clears = store.clear_folders(signup, version=1)
    late = store.initial_load(rows.filter(~before), version=2)
    log = store.union_log(early, clears, late)
    return store.current_view(log).select("doc_id", "folder_uri", "uid")


@register("pop_store_after_poll", with_views("pop_server", "pop_stored") + """
SELECT pop_id || '::' || folder_uri AS doc_id, folder_uri, pop_id, msg_num FROM pop_server""")
def pop_store_after_poll(spark, sf_dir):
    """Y6 + Y7 + Y8 as one POP poll on the change log: the store equals the server listing after it."""
    cols = ["folder_uri", "pop_id", "msg_num"]
    stored = fx.pop_stored(spark, sf_dir).select("folder_uri", "pop_id")
    listing = fx.pop_server(spark, sf_dir).select(*cols)
    folders = listing.select("folder_uri").distinct()
    log0 = store.initial_load(stored, version=0)
    changes = sync.pop_poll(store.with_doc_id(stored), listing, folders, version=1)
    view = store.current_view(store.union_log(log0, store.as_log(changes)))
    # messages stored earlier carry no number; the listing supplies the current one
    return view.select("doc_id", "folder_uri", "pop_id").join(listing, ["folder_uri", "pop_id"], "inner") \
        .select("doc_id", *cols)
