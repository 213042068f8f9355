"""The stored table: an append-only change log and its current view.

Plain Parquet tables take no MERGE / DELETE, so an upsert is a log row with a
higher (version, seq), a delete a tombstone row, and a folder clear one row per
folder.  The current view finds, per ``doc_id``, the highest (version, seq) by a
narrow aggregate, joins the whole rows back, drops tombstones, and drops rows
older than the latest clear of their folder.

Folder state, open errors and snapshot state are small next to the log.  Each version of
them holds the whole table, so a reader opens one version, and older ones are removed.
The folder state is written last: its version is the record that a batch is committed.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailframe.functions.keys import doc_id as doc_id_col
from mailframe.functions.keys import uid_from_doc_id
from mailframe.operators.sync import OP_CLEAR, OP_DELETE, OP_FLAGS, OP_UPSERT, SEQ_NEW

LOG_META = ["op", "version", "seq"]
PARTITION_COLUMNS = ["version", "index_name", "type_name", "fbucket"]
# Versions of the folder state, the open errors and the snapshot state that stay readable.
KEEP_VERSIONS = 3
# Fixed value: number of folder hash buckets the log is partitioned by.
FOLDER_BUCKETS = 64


def folder_bucket(folder_uri="folder_uri"):
    """Hash bucket of a folder: the log's second partition column, so a poll of some
    folders reads only their buckets (dynamic partition pruning on the join)."""
    c = F.col(folder_uri) if isinstance(folder_uri, str) else folder_uri
    return F.pmod(F.xxhash64(c), F.lit(FOLDER_BUCKETS)).cast("int")


def with_doc_id(df: DataFrame) -> DataFrame:
    """Add ``doc_id`` (P5) unless present.  Works for IMAP (uid) and POP (pop_id) rows."""
    if "doc_id" in df.columns:
        return df
    return df.withColumn("doc_id", _computed_doc_id(df))


def document_id(df: DataFrame):
    """``doc_id`` of each row of ``df``: its own where it has one, else computed."""
    return F.coalesce(F.col("doc_id"), _computed_doc_id(df)) if "doc_id" in df.columns else _computed_doc_id(df)


def _computed_doc_id(df: DataFrame):
    pop = "pop_id" if "pop_id" in df.columns else None
    uid = F.col("uid") if "uid" in df.columns else F.lit(None).cast("bigint")
    return doc_id_col(uid, pop, "folder_uri")


def initial_load(rows: DataFrame, version: int = 0) -> DataFrame:
    """K1 first run: every row is an upsert at ``version``."""
    return (
        with_doc_id(rows)
        .withColumn("op", F.lit(OP_UPSERT))
        .withColumn("version", F.lit(version).cast("bigint"))
        .withColumn("seq", F.lit(SEQ_NEW))
    )


def delete_keys(keys: DataFrame, version: int, seq: int = 3) -> DataFrame:
    """K4 / K6: tombstones for a set of keys (``doc_id`` or uid/pop_id + folder_uri)."""
    return with_doc_id(keys).withColumn("op", F.lit(OP_DELETE)) \
        .withColumn("version", F.lit(version).cast("bigint")).withColumn("seq", F.lit(seq))


def delete_where(view: DataFrame, predicate, version: int, seq: int = 3) -> DataFrame:
    """K6: delete by predicate in one pass (the reference loops over pages of 10,000)."""
    return delete_keys(view.filter(predicate), version, seq)


def clear_folders(folders: DataFrame, version: int, seq: int = 0) -> DataFrame:
    """K5: one tombstone per folder; hides every older row of that folder."""
    return folders.select("folder_uri").distinct().withColumn("doc_id", F.lit(None).cast("string")) \
        .withColumn("op", F.lit(OP_CLEAR)).withColumn("version", F.lit(version).cast("bigint")) \
        .withColumn("seq", F.lit(seq))


def as_log(changes: DataFrame) -> DataFrame:
    """Y13 change rows -> log rows (fills ``doc_id`` where missing; clears keep a null id)."""
    computed = _computed_doc_id(changes)
    key = F.coalesce(F.col("doc_id"), computed) if "doc_id" in changes.columns else computed
    return changes.withColumn("doc_id", F.when(F.col("op") == OP_CLEAR, F.lit(None).cast("string")).otherwise(key))


FLAG_COLUMNS = ("flaghashcode", "flags")


def _order():
    """(version, seq) as one number, so that its maximum is a hash aggregate."""
    return F.col("version") * 8 + F.col("seq")


def current_view(log: DataFrame) -> DataFrame:
    """L4: the visible table after applying the log in (version, seq) order.

    Per ``doc_id`` one partially aggregating pass finds when the latest whole row
    (upsert or delete) and the latest flags row came; flags newer than the row
    replace its flag columns.  Filters on the view's columns reach the scan of the
    whole rows.

    Both joins are by ``doc_id`` alone and merge sorted rows, so the second one shuffles only
    the flags rows.  Neither side may be broadcast: each grows with the store, and the planner,
    which takes a share of the file size for the columns it reads, holds columns that are mostly
    null (the default table's) for the larger part and guesses far too little.
    """
    flag_cols = [c for c in FLAG_COLUMNS if c in log.columns]
    rows = log.withColumn("_at", _order())
    is_flags = F.col("op") == OP_FLAGS
    # Per document two numbers: when its latest whole row and its latest flags row came.
    latest = (
        rows.filter(F.col("op") != OP_CLEAR)
        .groupBy("doc_id")
        .agg(F.max(F.when(~is_flags, F.col("_at"))).alias("_row_at"), F.max(F.when(is_flags, F.col("_at"))).alias("_flags_at"))
    )
    winners = latest.filter(F.col("_row_at").isNotNull()).withColumnRenamed("doc_id", "_doc")
    wide = rows.filter(F.col("op") == OP_UPSERT)
    # no whole row is later than the winner: >= says the same as ==, but is no second key to shuffle by
    visible = wide.join(winners.hint("merge"), (F.col("doc_id") == F.col("_doc")) & (F.col("_at") >= F.col("_row_at"))).drop("_doc")
    if flag_cols:
        flags = rows.filter(is_flags).select(
            F.col("doc_id").alias("_doc"), F.col("_at").alias("_f_at"), *[F.col(c).alias(f"_f_{c}") for c in flag_cols]
        ).dropDuplicates(["_doc", "_f_at"])
        newer = F.col("_flags_at") > F.col("_row_at")
        visible = visible.join(
            flags.hint("merge"), newer & (F.col("doc_id") == F.col("_doc")) & (F.col("_flags_at") <= F.col("_f_at")), "left"
        )
        for c in flag_cols:
            visible = visible.withColumn(c, F.when(F.col("_f_at").isNotNull(), F.col(f"_f_{c}")).otherwise(F.col(c)))
        visible = visible.drop("_doc", "_f_at", *[f"_f_{c}" for c in flag_cols])
    clears = rows.filter(F.col("op") == OP_CLEAR).groupBy(F.col("folder_uri").alias("_folder")).agg(F.max("_at").alias("_clear"))
    visible = visible.join(clears, F.col("folder_uri") == F.col("_folder"), "left").filter(
        F.col("_clear").isNull() | (F.col("_at") > F.col("_clear"))
    )
    return visible.drop("_at", "_row_at", "_flags_at", "_folder", "_clear", "fbucket", *LOG_META)


def narrow_view(log: DataFrame) -> DataFrame:
    """``current_view`` of a few narrow columns (keys, flag hash): one aggregation, and no join but that with the folder clears."""
    rows = log.withColumn("_at", _order())
    whole = [c for c in log.columns if c not in ("doc_id", "op", "version", "seq", "fbucket")]
    is_flags = F.col("op") == OP_FLAGS
    # dealt by document first: a document has few rows, so sorting them before the shuffle too would save nothing
    last = rows.filter(F.col("op") != OP_CLEAR).repartition("doc_id").groupBy("doc_id").agg(
        F.max(F.when(~is_flags, F.struct("_at", "op", *whole))).alias("_row"),
        F.max(F.when(is_flags, F.struct("_at", *[c for c in FLAG_COLUMNS if c in whole]))).alias("_flags"),
    )
    newer = F.coalesce(F.col("_flags._at") > F.col("_row._at"), F.lit(False))
    live = last.filter(F.col("_row.op") == OP_UPSERT).select(
        "doc_id", F.col("_row._at").alias("_at"),
        *[(F.when(newer, F.col(f"_flags.{c}")).otherwise(F.col(f"_row.{c}")) if c in FLAG_COLUMNS else F.col(f"_row.{c}")).alias(c) for c in whole],
    )
    clears = rows.filter(F.col("op") == OP_CLEAR).groupBy(F.col("folder_uri").alias("_folder")).agg(F.max("_at").alias("_clear"))
    live = live.join(clears, F.col("folder_uri") == F.col("_folder"), "left").filter(F.col("_clear").isNull() | (F.col("_at") > F.col("_clear")))
    return live.drop("_at", "_folder", "_clear")


def union_log(*parts: DataFrame) -> DataFrame:
    """Union of log parts with missing columns filled by nulls."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def cluster_by_bucket(rows: DataFrame) -> DataFrame:
    """Group rows by (folder bucket, hash sub-bucket of the document) before a write.

    Without it every task writes a file into every bucket it holds (tasks x buckets
    files per version).  With about ``shuffle.partitions / FOLDER_BUCKETS`` sub-buckets
    the files per version stay near the partition count, and a hot folder (one
    bucket) still spreads over several tasks.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = max(1, -(-n // FOLDER_BUCKETS))
    sub = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.col("folder_uri"))), F.lit(k))
    return rows.withColumn("_sub", sub).repartition(n, "fbucket", "_sub").drop("_sub")


# Persistent store -----------------------------------------------------------


class MailStore:
    """A change log on shared storage, partitioned by (``version``, target index and type,
    folder bucket), plus folder-state, snapshot-state, error and metrics tables (K1-K8).

    ``root`` must be a shared folder (the cluster's storage, never a machine-local
    one).  Writes are appends of one batch's rows, tagged with ``version``; a batch
    written twice overwrites its own partitions, so replays are idempotent (T4).
    ``index_name`` and ``type_name`` are partitions (K10): a read of one target table,
    or of those an accounts table names, opens their folders alone.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None):
        self.spark = spark
        self.root = root
        self.schema = schema
        self._base_log_path = os.path.join(root, "log")
        self.state_path = os.path.join(root, "folder_state")
        self.errors_path = os.path.join(root, "mail_errors")
        self.snapshots_path = os.path.join(root, "snapshot_state")
        self.landed_path = os.path.join(root, "snapshot_rows")
        self.metrics_path = os.path.join(root, "poll_metrics")
        self.schema_path = os.path.join(root, "_schema")
        self._known_schema: T.StructType | None = None
        self._staged: list[str] = []

    def _fs(self, p: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _path_exists(self, p: str) -> bool:
        fs, path = self._fs(p)
        return fs.exists(path)

    def _remove(self, p: str) -> None:
        fs, path = self._fs(p)
        fs.delete(path, True)

    def _numbered(self, folder: str, prefix: str, complete: bool = True) -> list[int]:
        """Numbers N of the folders ``prefix``N below ``folder``, ascending; only those whose write has ended, if ``complete``."""
        fs, path = self._fs(folder)
        if not fs.exists(path):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(path) if status.isDirectory()]
        found = [n for n in names if n.startswith(prefix) and n[len(prefix):].isdigit()]
        return sorted(int(n[len(prefix):]) for n in found if not complete or self._path_exists(os.path.join(folder, n, "_SUCCESS")))

    @property
    def log_path(self) -> str:
        """The current log folder: the latest compaction that has ended, else ``log``.
        Resolved on every access, so a running stream follows a compaction."""
        compacted = self._numbered(self.root, "log-c")
        return os.path.join(self.root, f"log-c{compacted[-1]}") if compacted else self._base_log_path

    def create_if_absent(self, schema: T.StructType | None = None, options=None) -> bool:
        """K3: create the (empty) log table with the caller's schema, else the default
        mail schema, plus the header fields that ``options`` select and the log columns;
        an existing table is never altered.  Returns True when the table was created."""
        if self.exists():
            return False
        from mailframe.functions.document import header_field_name
        from mailframe.schema import MAIL

        base = schema or self.schema or MAIL
        fields = list(base.fields)
        names = {f.name for f in fields}
        for header in options.headers_to_fields if options else ():
            name = header_field_name(header)
            if name not in names:
                fields.append(T.StructField(name, T.StringType()))
                names.add(name)
        for name, dtype in (("folder_uri", T.StringType()), ("index_name", T.StringType()), ("type_name", T.StringType()), ("account", T.StringType()), ("pop_id", T.StringType()), ("op", T.StringType()),
                            ("seq", T.IntegerType()), ("version", T.LongType()), ("fbucket", T.IntegerType())):
            if name not in names:
                fields.append(T.StructField(name, dtype))
        empty = self.spark.createDataFrame([], T.StructType(fields))
        # an empty partitioned write leaves no data file, so the schema is kept beside the log
        empty.write.mode("overwrite").parquet(self.schema_path)
        empty.write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(self.log_path)
        return True

    # K3: the table exists once something is written; the schema is never altered.
    def exists(self) -> bool:
        return self._path_exists(self.log_path)

    def next_version(self) -> int:
        """One above every version in use (0 for an empty store), from folder names alone (no data is read)."""
        used = self._numbered(self.log_path, "version=", complete=False)
        for path in (self.state_path, self.snapshots_path, self.landed_path):
            used += self._numbered(path, "version=", complete=False)
        return max(used, default=-1) + 1

    def committed(self, version: int) -> bool:
        """T4: whether the batch of this version has ended; its folder state is what it writes last."""
        return self._path_exists(os.path.join(self.state_path, f"version={version}", "_SUCCESS"))

    def append(self, log_rows: DataFrame) -> None:
        """K1 / K2: write one batch of log rows.

        Partitioned by (version, index, type, folder bucket): a replayed batch overwrites exactly its
        own partitions (T4), and a poll reads only the buckets of its folders.  Files are sorted by
        ``doc_id`` and carry a bloom filter on it, so a lookup by id reads few row groups (S8).
        """
        if "fbucket" not in log_rows.columns:
            log_rows = log_rows.withColumn("fbucket", folder_bucket())
        for c in ("index_name", "type_name"):
            if c not in log_rows.columns:
                log_rows = log_rows.withColumn(c, F.lit(None).cast("string"))
        self._keep_schema(log_rows)
        self._write_log(cluster_by_bucket(log_rows), self.log_path)

    def _write_log(self, rows: DataFrame, path: str, mode: str = "dynamic") -> None:
        (
            rows.sortWithinPartitions(*PARTITION_COLUMNS, "doc_id").write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .option("parquet.bloom.filter.enabled#doc_id", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")  # as large as the row group's ids need
            .partitionBy(*PARTITION_COLUMNS)
            .parquet(path)
        )

    def _keep_schema(self, log_rows: DataFrame) -> None:
        """One schema for the whole table: ``create_if_absent`` or the first write lays it down,
        and a column that a later write brings is added, so no read ever drops it."""
        known = self._schema_now()
        if known is None:
            log_rows.limit(0).write.mode("overwrite").parquet(self.schema_path)
            self._known_schema = None
        elif set(log_rows.columns) - set(known.fieldNames()):
            empty = self.spark.createDataFrame([], known)
            wider = empty.unionByName(log_rows.limit(0), allowMissingColumns=True).schema
            self.spark.createDataFrame([], wider).write.mode("overwrite").parquet(self.schema_path)
            self._known_schema = wider

    def _schema_now(self, again: bool = False) -> T.StructType | None:
        """The table's schema; read once by a writer, which keeps it, and anew by every ``log()``."""
        if self._known_schema is None or again:
            if not self._path_exists(self.schema_path):
                return None
            self._known_schema = self.spark.read.parquet(self.schema_path).schema
        return self._known_schema

    def log(self, fresh: bool = True) -> DataFrame:
        known = self._schema_now(again=fresh)
        return self.spark.read.schema(known).parquet(self.log_path) if known else self.spark.read.parquet(self.log_path)

    def view(self, folder: str | None = None, index_name: str | None = None, type_name: str | None = None,
             indexes: DataFrame | None = None) -> DataFrame:
        """The current documents; of one folder, one target table (F9), or the target tables that ``indexes``
        (``index_name``) names: only their partitions are read, for a table of names by dynamic pruning."""
        from mailframe.operators.search import restrict

        log = restrict(self.log(), index_name, type_name)
        if indexes is not None:
            log = log.join(indexes.select("index_name").distinct(), "index_name", "left_semi")
        if folder is not None:
            log = log.filter((F.col("fbucket") == folder_bucket(F.lit(folder))) & (F.col("folder_uri") == folder))
        return current_view(log)

    def lookup(self, ids: list[str]) -> DataFrame:
        """The current documents with these ids (a few; many are a join with the view).

        An id names its folder, so only the buckets of the ids are read, there only
        the row groups that can hold them (sorted files, statistics, bloom filters).  A folder
        clear has no id: the clears of these folders are read beside the documents' rows.
        """
        folders = sorted({i.split("::", 1)[1] for i in ids if "::" in i})
        if not folders:
            return current_view(self.log().limit(0))
        hashed = self.spark.range(1).select(F.explode(F.lit(folders)).alias("f")).select(folder_bucket("f").alias("b"))
        buckets = sorted({r["b"] for r in hashed.collect()})
        log = self.log().filter(F.col("fbucket").isin(buckets))
        mine = log.filter(F.col("doc_id").isin(ids))
        clears = log.filter((F.col("op") == OP_CLEAR) & F.col("doc_id").isNull() & F.col("folder_uri").isin(folders))
        return current_view(mine.unionByName(clears))

    def compact(self, upto_version: int) -> None:
        """Rewrite the log as its current view (one upsert per live row) at ``upto_version``.

        Runs on a schedule; cuts both log size and lineage.  Only committed batches are
        compacted: where polls keep their state here, a higher version is lowered to the last committed
        one, so no batch that Spark may still repeat is among them, and a repeat of an
        earlier one is told by ``committed`` and changes nothing.  Readers and writers turn to the new folder
        once its write has ended.
        """
        ended = self._numbered(self.state_path, "version=")
        upto = min(upto_version, ended[-1]) if ended else upto_version
        new_path = os.path.join(self.root, f"log-c{upto}")
        if new_path == self.log_path:
            return
        log = self.log()
        live = current_view(log.filter(F.col("version") <= upto)).withColumn("op", F.lit(OP_UPSERT)).withColumn("seq", F.lit(SEQ_NEW))
        live = live.withColumn("version", F.lit(upto).cast("bigint")).withColumn("fbucket", folder_bucket())
        later = log.filter(F.col("version") > upto)
        self._write_log(cluster_by_bucket(live.unionByName(later, allowMissingColumns=True)), new_path, "static")

    # Whole-table versions: folder state, open errors, snapshot state -------------------

    def _before(self, path: str, version: int | None, schema: T.StructType) -> DataFrame | None:
        """The table as of the latest ended version below ``version`` (the latest of all when None)."""
        ended = [v for v in self._numbered(path, "version=") if version is None or v < version]
        return self.spark.read.schema(schema).parquet(os.path.join(path, f"version={ended[-1]}")) if ended else None

    def _write_version(self, path: str, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(os.path.join(path, f"version={version}"))
        for old in [v for v in self._numbered(path, "version=") if v <= version][:-KEEP_VERSIONS]:
            self._remove(os.path.join(path, f"version={old}"))

    # K7: folder state, one row per folder, latest write wins.
    def write_state(self, state: DataFrame, version: int) -> None:
        """Rows of the folders that a batch changed; the version holds them and all others as they were."""
        before = self.state_before(version)
        if before is not None:
            state = state.unionByName(before.join(state.select("folder_uri"), "folder_uri", "left_anti"))
        self._write_version(self.state_path, state, version)

    def state(self) -> DataFrame | None:
        return self.state_before(None)

    def state_before(self, version: int | None) -> DataFrame | None:
        from mailframe.schema import FOLDER_STATE

        return self._before(self.state_path, version, FOLDER_STATE)

    # K8: open errors, the last error per message.
    def append_errors(self, errors: DataFrame, version: int) -> None:
        """Errors of a batch; a row with a null message closes the message's error."""
        before = self.errors_before(version)
        errors = before.limit(0).unionByName(errors, allowMissingColumns=True).dropDuplicates(["message_id"])
        kept = before.join(errors.select("message_id"), "message_id", "left_anti")
        self._write_version(self.errors_path, kept.unionByName(errors.filter(F.col("error_msg").isNotNull())), version)

    def errors(self) -> DataFrame:
        """Open errors: the latest row per message, unless that row marks it resolved (null message)."""
        return self.errors_before(None)

    def errors_before(self, version: int | None) -> DataFrame:
        from mailframe.schema import MAIL_ERRORS

        found = self._before(self.errors_path, version, MAIL_ERRORS)
        return self.spark.createDataFrame([], MAIL_ERRORS) if found is None else found

    # Numbered snapshots.
    def snapshots_before(self, version: int | None) -> DataFrame:
        from mailframe.schema import SNAPSHOT_STATE

        found = self._before(self.snapshots_path, version, SNAPSHOT_STATE)
        return self.spark.createDataFrame([], SNAPSHOT_STATE) if found is None else found

    def write_snapshots(self, snapshots: DataFrame, version: int) -> None:
        self._write_version(self.snapshots_path, snapshots, version)

    def land(self, rows: DataFrame, version: int) -> None:
        """Rows of snapshots that are not complete yet, by the batch that brought them."""
        rows.write.mode("overwrite").parquet(os.path.join(self.landed_path, f"version={version}"))

    def landed(self, since: int, upto: int, schema: T.StructType) -> DataFrame | None:
        """Rows that the batches from ``since`` to ``upto`` landed."""
        paths = [os.path.join(self.landed_path, f"version={v}") for v in self._numbered(self.landed_path, "version=") if since <= v <= upto]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def forget_landed(self, below: int) -> None:
        for v in self._numbered(self.landed_path, "version=", complete=False):
            if v < below:
                self._remove(os.path.join(self.landed_path, f"version={v}"))

    # One row per folder and poll.
    def write_metrics(self, metrics: DataFrame, version: int) -> None:
        metrics.drop("version").write.mode("overwrite").parquet(os.path.join(self.metrics_path, f"version={version}"))

    def metrics(self) -> DataFrame:
        from mailframe.schema import POLL_METRICS

        if not self._path_exists(self.metrics_path):
            return self.spark.createDataFrame([], POLL_METRICS)
        return self.spark.read.schema(POLL_METRICS).parquet(self.metrics_path)

    def retry_errors(self, raw: DataFrame, version: int, options=None) -> int:
        """Parse the messages of open error rows again from ``raw`` (``folder_uri``, ``uid`` or
        ``pop_id``, ``raw``); store those that parse now, mark them resolved, keep the rest open.
        The reference never retries a message whose mark has moved past it."""
        from mailframe.operators.documents import fetch_documents
        from mailframe.options import MailOptions

        pop = "pop_id" in raw.columns
        key = "pop_id" if pop else "uid"
        known = self.errors()
        open_errors = known.filter(F.col("pop_id").isNotNull() == F.lit(pop))
        if not pop:  # rows written without key columns name the message alone
            open_errors = open_errors.withColumn("uid", F.coalesce("uid", uid_from_doc_id("message_id"))).filter(F.col("uid").isNotNull())
        changes = open_errors.select("folder_uri", key).withColumn("op", F.lit(OP_UPSERT)) \
            .withColumn("version", F.lit(version).cast("bigint")).withColumn("seq", F.lit(SEQ_NEW))
        docs, still = fetch_documents(changes, raw, options or MailOptions(), keys=("folder_uri", key), stage=self.stage)
        self.append(as_log(docs))
        left = still.select("message_id").distinct()
        resolved = open_errors.join(left, "message_id", "left_anti").withColumn("error_msg", F.lit(None).cast("string"))
        self.append_errors(still.unionByName(resolved, allowMissingColumns=True), version)
        self.release()
        return self.errors().count()

    def stage(self, df: DataFrame) -> DataFrame:
        """Write rows that several outputs need once, to the store's own staging folder, and read them back."""
        path = os.path.join(self.root, "_staging", uuid.uuid4().hex)
        df.write.parquet(path)
        self._staged.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Remove what was staged; no frame that reads it may be used afterwards."""
        while self._staged:
            self._remove(self._staged.pop())
