"""Queries over a stored table: polls in odd orders, mixed accounts, lookups, routing, metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailframe.functions import document as doc
from mailframe.functions import text
from mailframe.functions.keys import doc_id
from mailframe.operators import search
from mailframe.operators import store as st
from mailframe.operators.store import MailStore
from mailframe.options import MailOptions
from mailframe.plans.document_queries import _customer_addresses
from mailframe.plans.registry import register
from mailframe.plans.sync_queries import _STORE_AFTER_POLL_SQL, _landed
from mailframe.session import checkpoint_path
from mailframe.sources import accounts as acc
from mailframe.sources import fixtures as fx
from mailframe.sources.fixtures import with_views
from mailframe.streaming.poll import PollJob, start_poll

_VIEW = ["doc_id", "folder_uri", "uid", "flaghashcode"]


def _new_store(spark, name: str) -> MailStore:
    return MailStore(spark, checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}"))


def _cleared(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("snapshot_rows").isNull())


# Polls in odd orders -------------------------------------------------------------


@register("late_older_snapshot", with_views("server") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, folder_uri, uid, flaghashcode FROM server""")
def late_older_snapshot(spark, sf_dir):
    """Snapshot 1 is complete only after snapshot 2 was applied; it must change nothing, else
    the messages it lacks would be deleted and, being below the mark, never stored again."""
    mail_store = _new_store(spark, "late_older_snapshot")
    job = PollJob(spark, mail_store)
    first, last = fx.stored(spark, sf_dir), fx.server(spark, sf_dir)
    early = _landed(first.filter(F.col("uid") % 2 == 0), 1)
    middle = last.join(first.agg(F.max("uid").alias("top")), F.col("uid") <= F.col("top") + 100).drop("top")
    late = early.filter(F.col("snapshot_rows").isNotNull())
    for i, rows in enumerate((_landed(first, 0), _cleared(early), _landed(middle, 2), late, _landed(last, 3))):
        job(rows, i)
    return mail_store.view().select(*_VIEW)


@register("store_after_replay", _STORE_AFTER_POLL_SQL)
def store_after_replay(spark, sf_dir):
    """T4: a batch is repeated after the log was compacted with its rows (a restart that lost Spark's commit record)."""
    mail_store = _new_store(spark, "store_after_replay")
    job = PollJob(spark, mail_store)
    batches = [_landed(fx.stored(spark, sf_dir), 0), _landed(fx.server(spark, sf_dir), 1)]
    for i, rows in enumerate(batches):
        job(rows, i)
    mail_store.compact(1)
    job(batches[1], 1)
    job(_landed(fx.server(spark, sf_dir), 2), 2)
    return mail_store.view().select(*_VIEW, "received_date")


@register("mailbox_emptied", with_views("mailbox") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, folder_uri, uid, flaghashcode FROM mailbox WHERE account <> 'user1@example.com'""")
def mailbox_emptied(spark, sf_dir):
    """A complete snapshot without any folder clears the folders of its account, and of no other."""
    mail_store = _new_store(spark, "mailbox_emptied")
    job = PollJob(spark, mail_store)
    listing = _landed(fx.mailbox(spark, sf_dir), 0)
    job(listing, 0)
    empty = listing.filter(F.col("snapshot_rows").isNotNull() & (F.col("account") == "user1@example.com"))
    job(empty.withColumns({"snapshot_id": F.lit(1).cast("bigint"), "snapshot_rows": F.lit(0).cast("bigint")}), 1)
    return mail_store.view().select(*_VIEW)


@register("store_after_renumbering", with_views("server") + """
SELECT CAST(uid + 7 AS VARCHAR) || '::' || folder_uri AS doc_id, folder_uri, uid + 7 AS uid, flaghashcode FROM server""")
def store_after_renumbering(spark, sf_dir):
    """The server renumbers its folders (another UID validity); they are cleared and loaded anew."""
    mail_store = _new_store(spark, "store_after_renumbering")
    job = PollJob(spark, mail_store)
    job(_landed(fx.stored(spark, sf_dir), 0), 0)
    moved = _landed(fx.server(spark, sf_dir).withColumn("uid", F.col("uid") + 7), 1)
    job(moved.withColumn("uid_validity", F.lit(2).cast("bigint")), 1)
    return mail_store.view().select(*_VIEW)


@register("store_after_recurring", _STORE_AFTER_POLL_SQL)
def store_after_recurring(spark, sf_dir):
    """A recurring stream (processing-time trigger) on a table created beforehand takes up two snapshots as they land."""
    mail_store = _new_store(spark, "store_after_recurring")
    mail_store.create_if_absent(options=MailOptions(headers_to_fields=("Message-ID",)))
    landing = f"{mail_store.root}/landing"
    query = None
    try:
        for i, df in enumerate((fx.stored(spark, sf_dir), fx.server(spark, sf_dir))):
            _landed(df.withColumn("received_date", F.col("received_date").cast("timestamp_ntz")), i).write.mode("append").parquet(landing)
            if query is None:
                query = start_poll(spark, landing, mail_store, interval="1 second", checkpoint=f"{mail_store.root}/ckpt", name=f"recurring-{uuid.uuid4().hex[:8]}")
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
    # the default table keeps its own names for a document's fields; those a listing brings stand beside them
    return mail_store.view().select(*_VIEW, "received_date")


# Accounts of both kinds ------------------------------------------------------------


def _mixed_listing(mailbox: DataFrame) -> DataFrame:
    """user1's messages as POP rows (its 'click' folder is the inbox), all others as IMAP rows."""
    pop = F.col("account") == "user1@example.com"
    name = F.when(pop & (F.col("folder_full_name") == "click"), F.lit("INBOX")).otherwise(F.col("folder_full_name"))
    return mailbox.withColumns({
        "folder_full_name": name,
        "folder_uri": F.when(pop, F.concat(F.lit("pop3://user1%40example.com@mail.example.com/"), name)).otherwise(F.col("folder_uri")),
        "pop_id": F.when(pop, F.concat(F.lit("U"), F.col("uid").cast("string"))),
    })


def _accounts(spark, sf_dir) -> DataFrame:
    """user0 by IMAP from settings, user1 by POP from a directory export; user2 is in neither."""
    names = fx.mailbox(spark, sf_dir).select("account").distinct()
    settings = names.filter("account = 'user0@example.com'").select(F.lit(None).cast("string").alias("user"), F.array("account").alias("users"), F.lit("imaps").alias("protocol"))
    export = names.filter("account = 'user1@example.com'").select(F.concat(F.lit("cn="), F.col("account"), F.lit(",ou=people")).alias("dn"), F.col("account").alias("name"))
    return acc.accounts_from_settings(settings, id_col="protocol").select("account", "protocol").unionByName(
        acc.accounts_from_directory(export).select(F.col("login").alias("account"), F.lit("pop3s").alias("protocol")))


@register("poll_mixed_accounts", with_views("server") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, 'user0' AS index_name, 'IMAP' AS kind, flaghashcode FROM server WHERE account = 'user0@example.com'
UNION ALL
SELECT 'U' || uid || '::pop3://user1%40example.com@mail.example.com/INBOX', 'user1', 'POP',
  CASE WHEN uid <= (SELECT max(uid) * 4 // 5 FROM mailbox) THEN flags_before ELSE flaghashcode END
FROM (SELECT s.*, m.flaghashcode AS flags_before FROM server s JOIN mailbox m USING (uid)) WHERE account = 'user1@example.com' AND folder_full_name = 'click'""")
def poll_mixed_accounts(spark, sf_dir):
    """One poll for accounts of both kinds, from settings and from a directory; rows of an
    account that neither names are ignored.  POP messages keep the flags they came with."""
    mail_store = _new_store(spark, "poll_mixed_accounts")
    accounts = _accounts(spark, sf_dir)
    job = PollJob(spark, mail_store, accounts=lambda: accounts, options=MailOptions(mail_index_name_strategy="username_crop"))
    for i, df in enumerate((fx.stored(spark, sf_dir), fx.server(spark, sf_dir))):
        rows = _mixed_listing(df)
        landed = _landed(rows, i).drop("pop_id")
        ids = F.when(F.col("folder_uri").startswith("pop3:") & F.col("uid").isNotNull(), F.concat(F.lit("U"), F.col("uid").cast("string")))
        landed = landed.withColumn("pop_id", ids).withColumn("uid", F.when(F.col("pop_id").isNull(), F.col("uid")))
        job(landed, i)
    return mail_store.view().select("doc_id", "index_name", F.when(F.col("pop_id").isNull(), "IMAP").otherwise("POP").alias("kind"), "flaghashcode")


# Target tables, lookups, metrics ------------------------------------------------------


def _routed_store(spark, sf_dir, name: str) -> MailStore:
    """All messages stored, a target table for each account."""
    mail_store = _new_store(spark, name)
    rows = fx.mailbox(spark, sf_dir).select("folder_uri", "uid", "flaghashcode", "account", "folder_full_name")
    rows = rows.withColumns({"index_name": acc.index_name("username_crop", "account"), "type_name": F.lit("mail")})
    mail_store.append(st.initial_load(rows))
    return mail_store


@register("documents_of_index", with_views("mailbox") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, 'user1' AS index_name, flaghashcode FROM mailbox WHERE account = 'user1@example.com'""")
def documents_of_index(spark, sf_dir):
    """The documents of one target table; only its partitions are read."""
    return _routed_store(spark, sf_dir, "documents_of_index").view(index_name="user1", type_name="mail").select("doc_id", "index_name", "flaghashcode")


@register("documents_of_accounts", with_views("mailbox") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, split_part(account, '@', 1) AS index_name, flaghashcode
FROM mailbox WHERE account IN ('user0@example.com', 'user1@example.com')""")
def documents_of_accounts(spark, sf_dir):
    """The documents of the accounts of a table; its names prune the partitions at run time."""
    names = _accounts(spark, sf_dir).select(acc.index_name("username_crop", "account").alias("index_name"))
    return _routed_store(spark, sf_dir, "documents_of_accounts").view(indexes=names).select("doc_id", "index_name", "flaghashcode")


@register("document_by_id", with_views("mailbox") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, folder_uri, uid, flaghashcode
FROM mailbox WHERE uid IN (SELECT min(uid) FROM mailbox UNION ALL SELECT max(uid) FROM mailbox)""")
def document_by_id(spark, sf_dir):
    """Two documents by their ids, out of the stored log of all."""
    mail_store = _routed_store(spark, sf_dir, "document_by_id")
    ids = fx.mailbox(spark, sf_dir).select("uid", doc_id("uid", None, "folder_uri").alias("id"))
    ends = ids.agg(F.min_by("id", "uid"), F.max_by("id", "uid")).first()
    return mail_store.lookup([*ends, "none::nowhere"]).select(*_VIEW)


@register("poll_metrics", with_views("server") + """,
folders AS (SELECT account, folder_uri, folder_full_name = 'click' AS away, count(*) AS n FROM server GROUP BY ALL)
SELECT v AS version, account, folder_uri,
  CASE WHEN v = 0 OR (v = 3 AND away) THEN 'initial' WHEN away AND v < 3 THEN 'vanished' ELSE 'incremental' END AS mode,
  CAST(CASE WHEN away AND v IN (1, 2) THEN 0 ELSE n END AS BIGINT) AS n_listed,
  CAST(CASE WHEN v = 0 OR (v = 3 AND away) THEN n ELSE 0 END AS BIGINT) AS n_new,
  CAST(0 AS BIGINT) AS n_flags, CAST(0 AS BIGINT) AS n_deleted, away AND v = 1 AS cleared
FROM folders, range(4) r(v)""")
def poll_metrics(spark, sf_dir):
    """Listed, stored, changed and deleted messages per folder and poll, over four polls of which two lack a folder."""
    mail_store = _new_store(spark, "poll_metrics")
    job = PollJob(spark, mail_store)
    listing = fx.server(spark, sf_dir)
    without = listing.filter(F.col("folder_full_name") != "click")
    for i, df in enumerate((listing, without, without, listing)):
        job(_landed(df, i), i)
    return mail_store.metrics().drop("index_name")


@register("nested_recipients", """
SELECT c_custkey, c_custkey % 97 = 5 AS same_element, false AS two_elements, c_custkey % 97 = 5 AS flat FROM customer""")
def nested_recipients(spark, sf_dir):
    """two conditions on one recipient; flat filters on e-mail and name find pairs that no recipient has."""
    every = _customer_addresses(spark, sf_dir).select("c_custkey", doc.all_recipients("to", "cc", "bcc").alias("all"))
    account = lambda a: a["personal"] == "Account 5"
    flat = search.nested("all", lambda a: a["email"].startswith("nation")) & search.nested("all", account)
    return every.select(
        "c_custkey",
        search.nested("all", lambda a: a["email"].startswith("acct"), account).alias("same_element"),
        search.nested("all", lambda a: a["email"].startswith("nation"), account).alias("two_elements"),
        flat.alias("flat"),
    )


@register("source_contains", with_views("mailbox") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id FROM mailbox WHERE flaghashcode = 36 AND folder_full_name = 'click'""")
def source_contains(spark, sf_dir):
    """substring test on the exported source of the documents."""
    rows = fx.mailbox(spark, sf_dir).select(doc_id("uid", None, "folder_uri").alias("doc_id"), doc.document_json(
        F.col("uid"), F.col("folder_full_name").alias("folderFullName"), F.col("flaghashcode")).alias("json"))
    return rows.filter(text.contains("json", '"folderFullName":"click"') & text.contains("json", '"flaghashcode":36}')).select("doc_id")
