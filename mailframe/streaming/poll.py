"""Recurring polls as Structured Streaming.

Server listings land as Parquet files (``SNAPSHOT_SCHEMA``); a row with a null
``uid`` / ``pop_id`` marks a folder even when it is empty.  A writer numbers each
listing of an account with a growing ``snapshot_id`` and says in ``snapshot_rows`` of
one row without a folder how many other rows the snapshot has.  A poll takes, per
account, the latest snapshot whose rows have all landed, whatever files and batches
they came in; incomplete ones change nothing, nor do those not above the one applied
last, however late they are complete (``admit_snapshots``).  A complete snapshot without any folder says
that all folders of its account have gone.  Rows without a snapshot id
are for writers that land a whole listing at once: then a batch is one complete
listing of the accounts it names.

``foreachBatch`` runs the whole poll (Y13) against the store's current
view and folder state, appends the change rows with ``version = batch_id`` and
then writes the next folder state in the same version:

* T1 recurring poll: ``trigger(processingTime=interval)``;
* T2 run once: ``trigger(availableNow=True)``;
* T3 per-folder state and per-account snapshot state across polls;
* T4 replay safety: a re-run batch overwrites its own ``version`` partition and
  reads only versions below its own, so it yields the same rows again; one that has
  committed (its folder state is written last) does nothing; the
  version is a per-checkpoint offset + batch id, so a new stream on an existing
  store never reuses a version;
* T5 one run at a time: micro-batches of one query are serial.

Data is committed before state, so a crash between the two replays the batch.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailframe.operators import store as st
from mailframe.operators import sync
from mailframe.schema import FOLDER_STATE, LISTING
from mailframe.session import checkpoint_path
from mailframe.sources.accounts import index_name, mailbox_kind
from mailframe.sources.raw import read_landing

LANDING_SCHEMA = T.StructType(LISTING.fields + [T.StructField("uid_validity", T.LongType())])
SNAPSHOT_SCHEMA = T.StructType([
    *LANDING_SCHEMA.fields,
    T.StructField("flags", T.ArrayType(T.StringType())),  # flag names as listed
    T.StructField("snapshot_id", T.LongType()),
    T.StructField("snapshot_rows", T.LongType()),
])

STATE_COLUMNS = FOLDER_STATE.fieldNames()


def admit_snapshots(rows: DataFrame, before: DataFrame, store: st.MailStore, version: int) -> tuple[DataFrame | None, DataFrame | None, DataFrame, int]:
    """Which numbered snapshots a batch completes: (listing rows, accounts, next snapshot state, oldest batch still needed).

    ``rows`` are the batch's numbered rows, which ``store`` holds as landed, ``before`` the snapshot state: per
    account the snapshot applied last, and the rows landed of later ones.  Rows of the applied
    snapshot and older ones change nothing, whenever they land.  Rows of later ones stay in
    ``store`` until their snapshot is complete: a marker row says how many there are, and as many
    different ones are here (a writer that tried again lands copies; they count once).  Of an
    account's complete snapshots the latest is applied and those below it are forgotten.

    Counts are partial aggregates by (account, snapshot), so an account with most rows of a batch
    is no hot task; a poll reads the landed rows of open snapshots alone, never the whole landing folder.
    """
    keys = ["account", "snapshot_id"]
    marker = F.col("snapshot_rows").isNotNull()
    new = rows.groupBy(*keys).agg(F.max("snapshot_rows").alias("want"), F.sum(F.when(marker, 0).otherwise(1)).alias("have"))
    new = new.withColumns({"since": F.lit(version).cast("bigint"), "done": F.lit(None).cast("bigint")})
    known = before.withColumn("done", F.when(F.col("applied"), F.col("snapshot_id"))).select(*new.columns)
    done = F.max("done").over(Window.partitionBy("account"))  # of an account the few snapshots that are open, and the one applied
    due = new.unionByName(known).groupBy(*keys).agg(F.max("want").alias("want"), F.sum("have").alias("have"), F.min("since").alias("since"), F.max("done").alias("done"))
    due = store.stage(due.withColumn("last", done).filter(F.col("last").isNull() | (F.col("snapshot_id") >= F.col("last"))))
    before_last, due = due.filter("done IS NOT NULL").select(*keys), due.filter("done IS NULL")
    enough = due.filter("have >= want")
    reach = due.agg(F.min("since").alias("all"), F.min(F.when(F.col("have") >= F.col("want"), F.col("since"))).alias("enough")).first()
    applied, listed, accounts = before_last, None, None
    if reach["enough"] is not None:
        landed = store.landed(reach["enough"], version, rows.schema).filter(F.col("snapshot_id").isNotNull())
        candidates = landed.join(enough.select(*keys), keys, "left_semi")
        each = candidates.groupBy(*keys, "folder_uri", "uid", "pop_id", "snapshot_rows").agg(F.count(F.lit(1)).alias("copies"))
        sizes = each.groupBy(*keys).agg(F.max("snapshot_rows").alias("want"), F.sum(F.when(marker, 0).otherwise(1)).alias("have"))
        latest = store.stage(sizes.filter(F.col("have") >= F.col("want")).groupBy("account").agg(F.max("snapshot_id").alias("snapshot_id")))
        listed = candidates.filter(~marker).join(latest, keys, "left_semi")
        accounts = latest.select("account")
        applied = before_last.unionByName(latest.select(*keys)).groupBy("account").agg(F.max("snapshot_id").alias("snapshot_id"))
    ends = applied.select(F.col("account").alias("_account"), F.col("snapshot_id").alias("_done"))
    still = due.join(ends, F.col("account").eqNullSafe(F.col("_account")), "left").filter(F.col("_done").isNull() | (F.col("snapshot_id") > F.col("_done")))
    state = applied.select(*keys, F.lit(True).alias("applied"), *[F.lit(None).cast("bigint").alias(c) for c in ("want", "have", "since")]).unionByName(
        still.select(*keys, F.lit(False).alias("applied"), "want", "have", "since"))
    state = store.stage(state)
    oldest = state.filter(~F.col("applied")).agg(F.min("since")).first()[0]
    return listed, accounts, state, version + 1 if oldest is None else oldest


def folder_table(folders: DataFrame, state: DataFrame) -> DataFrame:
    """One row per folder of a poll, listed now or known from before: how to poll it (``mode``,
    ``clear_first``, ``_mark``) and its old state (``_o_*``)."""
    old = state.select(*[F.col(c).alias("_o_" + c) for c in STATE_COLUMNS])
    j = folders.join(old, F.col("folder_uri") == F.col("_o_folder_uri"), "full")
    on_server, in_state = F.col("folder_uri").isNotNull(), F.col("_o_folder_uri").isNotNull()
    mode, clear_first = sync.poll_mode(on_server, in_state, F.coalesce("_o_exists", F.lit(True)), F.col("_o_uid_validity"), F.col("uid_validity"))
    # POP has no UID validity: a known folder is incremental
    kind = F.coalesce("kind", F.lit(sync.KIND_IMAP))
    mode = F.when((kind == sync.KIND_POP) & (mode == sync.MODE_RESYNC), F.lit(sync.MODE_INCREMENTAL)).otherwise(mode)
    named = [mode.alias("mode"), clear_first.alias("clear_first"), F.col("_o_last_uid").alias("_mark"), kind.alias("kind")]
    return j.select(
        F.coalesce("folder_uri", "_o_folder_uri").alias("folder_uri"), F.coalesce("account", "_o_account").alias("account"), "uid_validity", "n_listed", *named,
        *["_o_" + c for c in STATE_COLUMNS if c != "folder_uri"])


def advance_state(plan: DataFrame, counts: DataFrame, took_ms: int | None = None, index=None) -> DataFrame:
    """Y9 across polls: next state of every folder of this batch and of vanished folders, with the poll's counts.

    Full loads (initial / resync) restart the marks; incremental folders move the
    mark to the highest new UID; ``last_indexed`` moves only when rows were stored;
    vanished folders keep their row with ``exists = false``; a folder seen again
    is ``exists = true``.
    """
    now = F.current_timestamp()
    j = plan.join(counts, "folder_uri", "left")
    full = F.col("mode").isin(sync.MODE_INITIAL, sync.MODE_RESYNC)
    vanished = F.col("mode") == sync.MODE_VANISHED
    n = F.coalesce(F.col("n_new"), F.lit(0))
    # an incremental poll that stored nothing leaves the row as it was (reference rule)
    touched = full | (vanished & F.coalesce(F.col("_o_exists"), F.lit(True))) | (n > 0)
    prev_uid = F.when(full, F.lit(-1)).otherwise(F.coalesce(F.col("_o_last_uid"), F.lit(-1)))
    return j.select(
        F.coalesce(F.col("_o_index_name"), index(F.col("account")) if index else F.lit(None).cast("string")).alias("index_name"),
        "folder_uri",
        "account",
        (~vanished).alias("exists"),
        F.when(vanished, F.col("_o_uid_validity")).otherwise(F.col("uid_validity")).alias("uid_validity"),
        F.when(n > 0, F.greatest(prev_uid, F.coalesce(F.col("_max"), prev_uid))).otherwise(prev_uid)
        .cast("bigint").alias("last_uid"),
        F.when(full | (n > 0), n).otherwise(F.coalesce("_o_last_count", F.lit(-1))).cast("bigint").alias("last_count"),
        F.when(touched, F.lit(took_ms)).otherwise(F.col("_o_last_took")).cast("bigint").alias("last_took"),
        F.when(n > 0, now).otherwise(F.col("_o_last_indexed")).alias("last_indexed"),
        F.when(touched, now).otherwise(F.col("_o_last_schedule")).alias("last_schedule"),
        "mode",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_listed", "n_new", "n_flags", "n_deleted")],
        F.coalesce("cleared", F.lit(False)).alias("cleared"),
    )


class PollJob:
    """The per-batch body of a polling stream (also callable directly on a listing frame)."""

    def __init__(self, spark: SparkSession, mail_store: st.MailStore,
                 switches: sync.PollSwitches = sync.PollSwitches(), raw_path: str | None = None,
                 options=None, pop: bool = False, pop_by_number: bool = False, version_offset: int = 0,
                 accounts: DataFrame | Callable[[], DataFrame] | None = None):
        from mailframe.options import MailOptions

        self.spark = spark
        self.store = mail_store
        self.switches = switches
        # landing table of raw messages (folder_uri, uid | pop_id, raw; by preference partitioned by ``fbucket``)
        self.raw_path = raw_path
        self.options = options or MailOptions()
        # Without an accounts table all accounts are polled, by POP rules (key pop_id, no flags, no UID validity) if ``pop``.
        self.pop = pop
        self.pop_by_number = pop_by_number
        # accounts to poll: (account, protocol), read anew by each poll
        self.accounts = accounts
        self.version_offset = version_offset  # version = offset + batch id (see start_poll)

    def _kinds(self) -> DataFrame | None:
        """(account, kind) of the accounts to poll, one row each; None: all."""
        if self.accounts is None:
            return None
        table = self.accounts() if callable(self.accounts) else self.accounts
        return table.filter(F.col("account").isNotNull()).groupBy("account").agg(F.min(mailbox_kind("protocol")).alias("kind"))

    def _prior(self, version: int, folders: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        """Store view and state as of the versions before ``version``.

        The poll needs only keys and flag hashes of the polled folders, so the view
        is built from those narrow log columns of those folders alone.
        """
        state = self.store.state_before(version)
        state = state if state is not None else self.spark.createDataFrame([], FOLDER_STATE)
        if not self.store.exists():
            return None, state
        # at most FOLDER_BUCKETS values: a static partition filter prunes the other buckets
        buckets = sorted(r[0] for r in folders.select(st.folder_bucket().alias("b")).distinct().collect())
        log = self.store.log(fresh=False).filter((F.col("version") < version) & F.col("fbucket").isin(buckets))
        known = [c for c in ("uid", "pop_id", "flaghashcode") if c in log.columns]
        log = log.select("doc_id", "folder_uri", *known, "op", "version", "seq").join(folders.select("folder_uri"), "folder_uri", "left_semi")
        return st.narrow_view(log), state

    def _listed(self, batch: DataFrame, version: int) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None, int]:
        """(listing rows this poll may act on, the accounts they are whole listings of, next snapshot state, oldest
        landed batch still needed); no listing when there is nothing complete."""
        for name in ("flags", "snapshot_id", "snapshot_rows"):
            if name not in batch.columns:
                batch = batch.withColumn(name, F.lit(None).cast(SNAPSHOT_SCHEMA[name].dataType))
        batch = batch.select(*[F.col(f.name).cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SNAPSHOT_SCHEMA.fields])
        self.store.land(batch, version)  # written once; every branch below reads this table
        batch = self.store.landed(version, version, SNAPSHOT_SCHEMA)
        some = batch.agg(F.count("snapshot_id").alias("numbered"), F.count(F.lit(1)).alias("all")).first()
        if not some["all"]:
            return None, None, None, 0
        plain = batch.filter(F.col("snapshot_id").isNull())
        if not some["numbered"]:
            oldest = self.store.snapshots_before(version).filter(~F.col("applied")).agg(F.min("since")).first()[0]
            return plain, plain.select("account").distinct(), None, version + 1 if oldest is None else oldest
        numbered = batch.filter(F.col("snapshot_id").isNotNull())
        listed, accounts, snapshots, oldest = admit_snapshots(numbered, self.store.snapshots_before(version), self.store, version)
        if some["numbered"] < some["all"]:
            whole = plain.select("account").distinct()
            listed, accounts = (plain, whole) if listed is None else (plain.unionByName(listed), whole.unionByName(accounts).distinct())
        return listed, accounts, snapshots, oldest

    def _index(self, account) -> "F.Column":
        """Target index of an account."""
        return index_name(self.options.mail_index_name_strategy, account, self.options.mail_index_name)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        version = self.version_offset + int(batch_id)
        if self.store.committed(version):  # T4: a repeat of a batch that has ended, compacted or not, has nothing left to do
            return
        try:
            listed, accounts, snapshots, oldest = self._listed(batch, version)
            if listed is not None:
                self._poll(listed, accounts, version, snapshots)
            elif snapshots is not None:
                self.store.write_snapshots(snapshots, version)
            self.store.forget_landed(oldest)
        finally:
            self.store.release()

    def _poll(self, listed: DataFrame, accounts: DataFrame, version: int, snapshots: DataFrame | None) -> None:
        began = time.monotonic()
        kinds = self._kinds()
        if kinds is None:
            kind = F.lit(sync.KIND_POP if self.pop else sync.KIND_IMAP)
            listed, accounts = listed.withColumn("kind", kind), accounts.withColumn("kind", kind)
        else:  # stream-static join: accounts that are not in the table are not polled
            listed, accounts = listed.join(kinds, "account"), accounts.join(kinds, "account")
        listed = listed.filter((F.col("kind") == sync.KIND_IMAP) | (F.col("folder_full_name") == "INBOX"))  # S3: POP serves the inbox alone
        is_pop = F.col("kind") == sync.KIND_POP
        key = F.when(is_pop, F.col("pop_id").isNotNull()).otherwise(F.col("uid").isNotNull())
        # What a folder is called is one row per folder in every task already; only message keys are shuffled and hashed,
        # as landed copies of a row count once.
        named = listed.filter(F.col("folder_uri").isNotNull())
        folders = named.groupBy("folder_uri", "account", "kind").agg(F.max(F.when(~is_pop, F.col("uid_validity"))).alias("uid_validity")) \
            .groupBy("folder_uri").agg(F.first("account", ignorenulls=True).alias("account"), F.max("uid_validity").alias("uid_validity"), F.first("kind").alias("kind"))
        sizes = named.filter(key).select("folder_uri", "uid", "pop_id").distinct().groupBy("folder_uri").agg(F.count(F.lit(1)).alias("n_listed"))
        folders = folders.join(sizes, "folder_uri", "left").withColumn("n_listed", F.coalesce("n_listed", F.lit(0).cast("bigint")))
        listing = listed.filter(key).withColumns({
            "uid": F.when(~is_pop, F.col("uid")), "pop_id": F.when(is_pop, F.col("pop_id")), "msg_num": F.when(is_pop, F.col("msg_num"))})
        listing = listing.drop("uid_validity", "snapshot_id", "snapshot_rows", "kind")
        existing = folders
        if self.options.folderpattern is not None:  # F1-F4: poll only the selected folders
            folders = self._selected(listed, folders)
            listing = listing.join(folders.select("folder_uri"), "folder_uri", "left_semi")
        state = self.store.state_before(version)
        state = state if state is not None else self.spark.createDataFrame([], FOLDER_STATE)
        # Only accounts whose listing is whole can have vanished folders, whether they list a folder or none,
        # and a folder the pattern leaves out has not vanished while the server still lists it.
        state = state.join(accounts.select(F.col("account").alias("_a")).distinct(), F.col("account").eqNullSafe(F.col("_a")), "left_semi")
        if self.options.folderpattern is not None:
            unselected = existing.join(folders.select("folder_uri"), "folder_uri", "left_anti").select("folder_uri")
            state = state.join(unselected, "folder_uri", "left_anti")
        # One row per folder, written once; everything below reads it.
        plan = self.store.stage(folder_table(folders, state))
        view, _ = self._prior(version, plan.select("folder_uri"))
        if view is None:
            view = listing.select("folder_uri", "uid", "pop_id", "flaghashcode").limit(0)
        rules = plan.select("folder_uri", "account", "kind", "mode", "clear_first", "_mark")
        changes = sync.poll_changes(view, listing, rules, version, self.switches, self.pop_by_number)
        if self.raw_path is not None:
            changes = self.store.stage(self._with_pending(changes, listing, version))
        changes = changes.withColumn("index_name", self._index(F.col("account"))) \
            .withColumn("type_name", F.lit(self.options.mail_type_name))
        if self.raw_path is not None:
            changes = self._with_bodies(changes, version)
        self.store.append(st.as_log(changes))
        written = self.store.log(fresh=False).filter(F.col("version") == version)
        counts = written.groupBy("folder_uri").agg(
            F.max(F.when((F.col("op") == sync.OP_UPSERT) & (F.col("seq") == sync.SEQ_NEW), F.col("uid"))).alias("_max"),
            *[F.count(F.when(F.col("op") == op, F.lit(1))).alias(n) for n, op in (("n_new", sync.OP_UPSERT), ("n_flags", sync.OP_FLAGS), ("n_deleted", sync.OP_DELETE))],
            F.max(F.col("op") == sync.OP_CLEAR).alias("cleared"),
        ) if "uid" in written.columns else None
        if not self.switches.delete_expunged:
            plan = plan.filter(F.col("mode") != sync.MODE_VANISHED)
        took = int((time.monotonic() - began) * 1000)
        ended = self.store.stage(advance_state(plan, counts, took, self._index))
        self.store.write_metrics(ended.select("index_name", "account", "folder_uri", "mode", "n_listed", "n_new", "n_flags", "n_deleted", "cleared"), version)
        if snapshots is not None:
            self.store.write_snapshots(snapshots, version)
        self.store.write_state(ended.select(*STATE_COLUMNS), version)  # the commit

    def _selected(self, batch: DataFrame, folders: DataFrame) -> DataFrame:
        """Listed folders hold messages; non-matching ones hide their subtree."""
        from mailframe.operators.folders import select_folders

        names = batch.select("account", "folder_uri", "folder_full_name").distinct()
        tree = names.select("account", "folder_full_name", F.lit(True).alias("holds_messages")).distinct()
        picked = select_folders(tree, self.options.folderpattern, by=("account",)).filter(F.col("selected"))
        keep = names.join(picked.select("account", "folder_full_name"), ["account", "folder_full_name"], "left_semi")
        return folders.join(keep.select("folder_uri"), "folder_uri", "left_semi")

    def _with_pending(self, changes: DataFrame, listing: DataFrame, version: int) -> DataFrame:
        """Add the messages that still wait for their raw bytes and are still listed."""
        waiting = self.store.errors_before(version).filter(F.col("kind") == "missing").select(F.col("message_id").alias("doc_id"))
        again = st.with_doc_id(listing).join(waiting, "doc_id", "left_semi").dropDuplicates(["doc_id"]) \
            .withColumn("op", F.lit(sync.OP_UPSERT)).withColumn("version", F.lit(version).cast("bigint")).withColumn("seq", F.lit(sync.SEQ_NEW))
        again = again.join(changes.filter(F.col("op") == sync.OP_UPSERT).select("doc_id"), "doc_id", "left_anti")
        return changes.unionByName(again)

    def _with_bodies(self, changes: DataFrame, version: int) -> DataFrame:
        """Replace upsert rows by parsed documents; record failures and missing bytes, close what is settled (K8, P20)."""
        from mailframe.operators.documents import fetch_documents

        raw = read_landing(self.spark, self.raw_path)
        is_pop = F.col("pop_id").isNotNull()
        out, errors = changes.filter(F.col("op") != sync.OP_UPSERT), None
        for key, mine in (("uid", ~is_pop), ("pop_id", is_pop)):  # a landing holds the keys of one kind or of both
            if key in raw.columns and not (self.accounts is None and (key == "pop_id") != self.pop):
                docs, failed = fetch_documents(changes.filter(mine), raw, self.options, keys=("folder_uri", key), stage=self.store.stage)
                out = out.unionByName(docs.withColumn("uid", F.when(F.col("pop_id").isNull(), F.col("uid"))) if key == "pop_id" else docs, allowMissingColumns=True)
                errors = failed if errors is None else errors.unionByName(failed)
        if errors is not None:
            fixed = out.filter(F.col("op") == sync.OP_UPSERT).select(st.document_id(out).alias("message_id"))
            settled = self.store.errors_before(version).join(fixed, "message_id", "left_semi") \
                .withColumn("error_msg", F.lit(None).cast("string"))
            self.store.append_errors(errors.unionByName(settled, allowMissingColumns=True), version)
        return out


def _version_offset(spark: SparkSession, ckpt: str, mail_store: st.MailStore) -> int:
    """Log version of batch 0 of this stream, fixed once per checkpoint.

    A stream that restarts from its checkpoint replays a batch under the same
    version (T4); a new stream on an existing store starts above every version
    already written, so it never overwrites another stream's partitions.
    """
    marker = os.path.join(ckpt, "_version_offset")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(marker)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return int(spark.read.text(marker).first()[0])
    offset = mail_store.next_version()
    spark.createDataFrame([(str(offset),)], "v string").coalesce(1).write.mode("overwrite").text(marker)
    return offset


def start_poll(spark: SparkSession, landing: str, mail_store: st.MailStore, *,
               interval: str | None = None, once: bool = False,
               switches: sync.PollSwitches | None = None, name: str = "mail-poll",
               checkpoint: str | None = None, raw_path: str | None = None, options=None,
               pop: bool = False, pop_by_number: bool = False, files_per_batch: int | None = None,
               accounts: "DataFrame | Callable[[], DataFrame] | None" = None):
    """Start the polling query: ``once=True`` drains what has landed and stops.

    With ``raw_path`` the upserted messages are fetched from that raw landing table,
    parsed and stored as whole documents; parse failures go to the error table.
    ``accounts`` (``account``, ``protocol``; a frame, or a function that reads it anew for every
    poll) names the accounts to poll and by which rules; without it all are polled by those of ``pop``.
    ``files_per_batch=1`` makes every landed snapshot file its own poll; files are
    taken in modification-time order, so snapshots must land one after another.
    """
    from mailframe.options import MailOptions

    options = options or MailOptions()
    switches = switches or sync.PollSwitches.from_options(options)
    interval = interval or options.interval  # T1: 60 seconds unless configured
    reader = spark.readStream.schema(SNAPSHOT_SCHEMA)
    if files_per_batch:  # one landed snapshot file per poll, in landing order
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(landing)
    ckpt = checkpoint or checkpoint_path(spark, os.path.join("streams", name))
    job = PollJob(spark, mail_store, switches, raw_path=raw_path, options=options, pop=pop,
                  pop_by_number=pop_by_number, accounts=accounts, version_offset=_version_offset(spark, ckpt, mail_store))
    writer = stream.writeStream.foreachBatch(job).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.queryName(name).start()
