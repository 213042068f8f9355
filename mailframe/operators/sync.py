"""Snapshot synchronisation (Y1-Y13): what changed between the server listing and the store.

Every operator is a pure function DataFrame -> DataFrame.  The reference does these
steps with driver-side hash sets and one store lookup per message; here each is
one join that Catalyst plans (broadcast when the planner's size check allows it,
sort-merge otherwise, with AQE splitting skewed folders).

Inputs (column names):

* listing  - what a server holds now: ``folder_uri``, ``uid`` (IMAP) or
  ``pop_id`` (+ ``msg_num``) (POP), ``flaghashcode``, plus any payload columns.
* stored   - the current view of the store, same key columns.
* state    - ``folder_state``: ``folder_uri``, ``last_uid``, ``uid_validity``, ...
* folders  - one row per listed folder: ``folder_uri``, ``uid_validity``; a folder
  appears here only when its listing in this batch is complete, so a partial
  listing never looks like a mass deletion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IMAP_KEY = ["folder_uri", "uid"]
POP_KEY = ["folder_uri", "pop_id"]


def _non_null(df: DataFrame, keys: list[str]) -> DataFrame:
    """Anti joins keep left rows with a null key, which would turn into deletes."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def distinct_listing(listing: DataFrame, keys: list[str] = IMAP_KEY) -> DataFrame:
    """Duplicate listing rows collapse to one per key.

    The result is hash-partitioned on ``keys``, so the joins on the same keys that
    follow (Y3, Y4) reuse that partitioning instead of shuffling the listing again.
    """
    return _non_null(listing, keys).dropDuplicates(keys)


def folder_marks(stored: DataFrame) -> DataFrame:
    """A4/A5 over the store: per folder the highest stored UID and the row count."""
    return stored.groupBy("folder_uri").agg(
        F.max("uid").alias("last_uid"), F.count(F.lit(1)).alias("stored_count")
    )


def new_messages(listing: DataFrame, state: DataFrame) -> DataFrame:
    """Listed messages above the folder's high-water mark.

    ``last_uid`` < 1 (never indexed) or a missing state row means every message is
    new.  The mark is strict (``uid > last_uid``); the reference re-reads the
    message at the mark, which changes nothing once stored.
    """
    marks = state.select("folder_uri", F.col("last_uid").alias("_mark"))
    return (
        listing.join(marks, "folder_uri", "left")
        .filter(F.col("uid") > F.coalesce(F.col("_mark"), F.lit(0)))
        .drop("_mark")
    )


def flag_changes(listing: DataFrame, stored: DataFrame, keys: list[str] = IMAP_KEY) -> DataFrame:
    """Same message, different flag hash.  Not stored -> not a change."""
    old = stored.select(*keys, F.col("flaghashcode").alias("old_flaghashcode"))
    return listing.join(old, keys, "inner").filter(F.col("flaghashcode") != F.col("old_flaghashcode"))


def expunged(stored: DataFrame, listing: DataFrame, folders: DataFrame | None = None,
             keys: list[str] = IMAP_KEY) -> DataFrame:
    """Stored rows of completely listed folders that the server no longer lists.

    ``folders`` restricts deletes to folders whose listing is complete; without it the
    folders present in the listing are taken.  An empty but complete folder must be
    passed in ``folders`` to have all its rows deleted.
    """
    if folders is None:
        folders = listing.select("folder_uri").distinct()
    scoped = _non_null(stored, keys).join(folders.select("folder_uri"), "folder_uri", "left_semi")
    return scoped.join(_non_null(listing.select(*keys), keys), keys, "left_anti")


def still_listed(stored: DataFrame, listing: DataFrame, keys: list[str] = POP_KEY) -> DataFrame:
    """Stored rows whose key the server still lists."""
    return stored.join(listing.select(*keys), keys, "left_semi")


def pop_new(listing: DataFrame, stored: DataFrame) -> DataFrame:
    """Y6 default mode: listed POP messages whose UIDL is not stored (no gaps left behind)."""
    return _non_null(listing, POP_KEY).join(stored.select(*POP_KEY), POP_KEY, "left_anti")


def pop_new_by_number(listing: DataFrame, stored: DataFrame) -> DataFrame:
    """Y6 number mode: messages numbered above the highest-numbered message already stored.

    The highest number is taken over stored UIDLs the server still lists; none -> 0,
    so everything is new.  A gap below that number is never refilled (reference rule).
    """
    top = (
        listing.select(*POP_KEY, "msg_num")
        .join(stored.select(*POP_KEY), POP_KEY, "left_semi")
        .groupBy("folder_uri")
        .agg(F.max("msg_num").alias("_top"))
    )
    return (
        listing.join(top, "folder_uri", "left")
        .filter(F.col("msg_num") > F.coalesce(F.col("_top"), F.lit(0)))
        .drop("_top")
    )


def pop_expunged(stored: DataFrame, listing: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """Runs even when the mailbox is empty (pass the folder in ``folders``)."""
    return expunged(stored, listing, folders, POP_KEY)


def vanished_folders(stored_folders: DataFrame, server_folders: DataFrame,
                     on: tuple[str, ...] = ("account", "folder_full_name")) -> DataFrame:
    """Stored folder names the server no longer has (per account)."""
    on = list(on)
    return stored_folders.select(*on).distinct().join(server_folders.select(*on), on, "left_anti")


MODE_VANISHED = "vanished"
MODE_INITIAL = "initial"
MODE_RESYNC = "resync"
MODE_INCREMENTAL = "incremental"


def poll_mode(on_server: Column, in_state: Column, there: Column, old_validity: Column, new_validity: Column) -> tuple[Column, Column]:
    """(mode, clear_first) of a folder known on either side (rules: ``resync_plan``)."""
    changed = ~old_validity.eqNullSafe(new_validity) | old_validity.isNull()
    mode = (
        F.when(~on_server, F.lit(MODE_VANISHED))
        .when(~in_state | ~there, F.lit(MODE_INITIAL))
        .when(changed, F.lit(MODE_RESYNC))
        .otherwise(F.lit(MODE_INCREMENTAL))
    )
    return mode, (~on_server & there) | (in_state & old_validity.isNotNull() & (mode == MODE_RESYNC))


def resync_plan(server_folders: DataFrame, state: DataFrame) -> DataFrame:
    """One row per folder known on either side, with the poll mode.

    * on the store only                 -> ``vanished`` (clear, once; state exists=false)
    * on the server, no state row, or a
      state row that says it had vanished -> ``initial`` (full load)
    * validity null or different        -> ``resync`` (full load; clear first if the
      old validity was non-null)
    * else                              -> ``incremental``

    A rename is a vanished old name plus an initial new one (Y11).
    """
    srv = server_folders.select("folder_uri", F.col("uid_validity").alias("new_validity"), F.lit(True).alias("_on_server"))
    there = F.coalesce(F.col("exists"), F.lit(True)) if "exists" in state.columns else F.lit(True)
    st = state.select("folder_uri", F.col("uid_validity").alias("old_validity"), F.lit(True).alias("_in_state"), there.alias("_there"))
    j = srv.join(st, "folder_uri", "full")
    on_server = F.coalesce(F.col("_on_server"), F.lit(False))
    in_state = F.coalesce(F.col("_in_state"), F.lit(False))
    mode, clear_first = poll_mode(on_server, in_state, F.col("_there"), F.col("old_validity"), F.col("new_validity"))
    return j.select(
        "folder_uri",
        mode.alias("mode"),
        clear_first.alias("clear_first"),
        "old_validity",
        "new_validity",
    )


def state_advance(new_rows: DataFrame, state: DataFrame, now: Column | None = None,
                  pop: bool = False) -> DataFrame:
    """The next folder state after a poll that stored ``new_rows``.

    Per folder: ``last_uid`` = max uid (kept when nothing is new), ``last_count`` =
    rows stored now, ``last_indexed`` moves only when the count is > 0,
    ``last_schedule`` = now.  Folders with no state get the default row first (S9).
    """
    now = now if now is not None else F.current_timestamp()
    agg = new_rows.groupBy("folder_uri").agg(
        (F.max("uid") if not pop else F.lit(None).cast("bigint")).alias("_max_uid"),
        F.count(F.lit(1)).alias("_count"),
    )
    base = with_default_state(state)
    j = base.join(agg, "folder_uri", "full")
    got = F.coalesce(F.col("_count"), F.lit(0))
    return j.select(
        "folder_uri",
        F.coalesce(F.col("exists"), F.lit(True)).alias("exists"),
        F.col("uid_validity"),
        F.when(got > 0, F.greatest(F.coalesce(F.col("last_uid"), F.lit(-1)), F.coalesce(F.col("_max_uid"), F.lit(-1))))
        .otherwise(F.coalesce(F.col("last_uid"), F.lit(-1))).alias("last_uid"),
        F.when(got > 0, got).otherwise(F.coalesce(F.col("last_count"), F.lit(-1))).alias("last_count"),
        F.when(got > 0, now).otherwise(F.col("last_indexed")).alias("last_indexed"),
        now.alias("last_schedule"),
    )


def with_default_state(state: DataFrame) -> DataFrame:
    """A folder never seen reads as exists=true, marks -1, validity null."""
    return state.select(
        "folder_uri",
        F.coalesce(F.col("exists"), F.lit(True)).alias("exists"),
        F.col("uid_validity").cast("bigint").alias("uid_validity"),
        F.coalesce(F.col("last_uid"), F.lit(-1)).cast("bigint").alias("last_uid"),
        F.coalesce(F.col("last_count"), F.lit(-1)).cast("bigint").alias("last_count"),
        F.col("last_indexed").cast("timestamp").alias("last_indexed"),
    )


# Change rows (Y13) ---------------------------------------------------------

OP_CLEAR = "clear"
OP_UPSERT = "upsert"
OP_FLAGS = "flags"  # flag-only change: an IMAP message is immutable except its flags
OP_DELETE = "delete"
# order inside one poll: folder clears, flag updates, new rows, expunge deletes
SEQ_CLEAR, SEQ_FLAGS, SEQ_NEW, SEQ_DELETE = 0, 1, 2, 3


@dataclass(frozen=True)
class PollSwitches:
    with_flag_sync: bool = True
    delete_expunged: bool = True  # false = keep_expunged_messages

    @staticmethod
    def from_options(options) -> "PollSwitches":
        """The two sync switches of a ``MailOptions`` (``with_flag_sync``, ``keep_expunged_messages``)."""
        return PollSwitches(with_flag_sync=options.with_flag_sync, delete_expunged=not options.keep_expunged_messages)


def folder_plan(folders: DataFrame, state: DataFrame) -> DataFrame:
    """The poll mode of every folder with its old high-water mark."""
    marks = state.select("folder_uri", F.col("last_uid").alias("_mark"))
    return resync_plan(folders, state).join(marks, "folder_uri", "left").select("folder_uri", "mode", "clear_first", "_mark")


KIND_IMAP, KIND_POP = "IMAP", "POP"


def poll_changes(stored: DataFrame, listing: DataFrame, plan: DataFrame, version: int,
                 switches: PollSwitches = PollSwitches(), by_number: bool = False) -> DataFrame:
    """What one poll does to the store, as typed change rows, by one full outer join on the message key.

    ``stored`` and ``listing`` hold rows of IMAP folders (``uid``) and POP folders (``pop_id``)
    side by side; ``plan`` has one small row per folder: ``folder_uri``, ``kind`` (IMAP or POP
    rules), ``mode``, ``clear_first``, ``_mark`` (old high-water mark) and optionally ``account``.  Every
    message of either side meets its partner once, the folder's row names the rules, and
    the row's ``op`` follows from both:

    * IMAP: listed and above the mark (or in a folder that is loaded in full) -> upsert;
      listed and stored with another flag hash -> flags (content cannot change, so the message
      is not read again); stored but not listed, in an incremental folder -> delete;
    * POP: listed but not stored -> upsert (``by_number``: numbered above the highest stored
      and listed one); stored but not listed -> delete.

    Folders to clear give one row each.  Output: listing columns + ``doc_id``, ``op``, ``version``, ``seq``.
    """
    from mailframe.operators.store import with_doc_id

    # Y12; dealt by message first, so that rows are sorted once, for this and for the join
    listed = with_doc_id(listing).filter(F.col("doc_id").isNotNull()).repartition("doc_id").dropDuplicates(["doc_id"])
    cols = listed.columns
    old = with_doc_id(stored).filter(F.col("doc_id").isNotNull())
    old = old.select(*[F.col(c).alias("_s_" + c) for c in ("doc_id", "folder_uri", "uid", "pop_id", "flaghashcode") if c in old.columns])
    both = listed.join(old, F.col("doc_id") == F.col("_s_doc_id"), "full")
    here, there = F.col("doc_id").isNotNull(), F.col("_s_doc_id").isNotNull()
    for c in ("doc_id", "folder_uri", "uid", "pop_id"):
        if c in cols and "_s_" + c in both.columns:
            both = both.withColumn(c, F.coalesce(c, "_s_" + c)) if c != "doc_id" else both.withColumns({"_here": here, "_there": there})
    both = both.withColumn("doc_id", F.coalesce("doc_id", "_s_doc_id"))
    here, there = F.col("_here"), F.col("_there")

    folder = plan.select(F.col("folder_uri").alias("_folder"), *[F.col(c) if c != "account" else F.col(c).alias("_account") for c in plan.columns if c != "folder_uri"])
    rows = both.join(folder, F.col("folder_uri") == F.col("_folder"))
    if by_number:
        top = rows.filter(here & there).groupBy(F.col("folder_uri").alias("_of")).agg(F.max("msg_num").alias("_top"))
        rows = rows.join(top, F.col("folder_uri") == F.col("_of"), "left")
    imap, mode = F.col("kind") == KIND_IMAP, F.col("mode")
    incremental = mode == MODE_INCREMENTAL
    above = (F.col("uid") > F.coalesce(F.col("_mark"), F.lit(0))) if "uid" in cols else F.lit(False)
    new_pop = (F.col("msg_num") > F.coalesce(F.col("_top"), F.lit(0))) if by_number else ~there
    new = here & F.when(imap, mode.isin(MODE_INITIAL, MODE_RESYNC) | (incremental & above)).otherwise(new_pop)
    op = F.when(new, F.lit(OP_UPSERT))
    if switches.with_flag_sync and "flaghashcode" in cols and "_s_flaghashcode" in both.columns:
        op = op.when(here & there & imap & incremental & (F.col("flaghashcode") != F.col("_s_flaghashcode")), F.lit(OP_FLAGS))
    if switches.delete_expunged:
        op = op.when(there & ~here & F.when(imap, incremental).otherwise(mode != MODE_VANISHED), F.lit(OP_DELETE))
    out = rows.withColumn("op", op).filter(F.col("op").isNotNull())
    seq = F.when(F.col("op") == OP_FLAGS, SEQ_FLAGS).when(F.col("op") == OP_DELETE, SEQ_DELETE).otherwise(SEQ_NEW)
    if "account" in cols and "_account" in rows.columns:
        out = out.withColumn("account", F.coalesce("account", "_account"))

    clears = plan.filter("clear_first")
    if not switches.delete_expunged:  # Y5 runs only when deletes are on
        clears = clears.filter(F.col("mode") != MODE_VANISHED)
    known = [c for c in ("folder_uri", "account") if c in plan.columns]
    clears = clears.select(*[F.col(c) if c in known else F.lit(None).cast(listed.schema[c].dataType).alias(c) for c in cols])
    at = F.lit(version).cast("bigint").alias("version")
    return clears.select(*cols, F.lit(OP_CLEAR).alias("op"), at, F.lit(SEQ_CLEAR).alias("seq")).unionByName(
        out.select(*cols, "op", at, seq.cast("int").alias("seq")))


def imap_poll(stored: DataFrame, listing: DataFrame, folders: DataFrame, state: DataFrame,
              version: int, switches: PollSwitches = PollSwitches(), plan: DataFrame | None = None) -> DataFrame:
    """The whole IMAP poll as typed change rows (``poll_changes``).

    ``stored`` is the current view (keys + flag hash are enough), ``listing`` the
    server rows (with payload columns), ``folders`` the completely listed folders
    with their UID validity, ``state`` the folder state.  Output: listing columns +
    ``op``, ``version``, ``seq``; clears carry only ``folder_uri``.
    """
    plan = folder_plan(folders, state) if plan is None else plan
    if "kind" not in plan.columns:
        plan = plan.withColumn("kind", F.lit(KIND_IMAP))
    keyed = listing.filter(F.col("uid").isNotNull() & F.col("folder_uri").isNotNull())
    return poll_changes(stored, keyed, plan, version, switches).select(*listing.columns, "op", "version", "seq")


def pop_poll(stored: DataFrame, listing: DataFrame, folders: DataFrame, version: int,
             switches: PollSwitches = PollSwitches(), by_number: bool = False) -> DataFrame:
    """The whole POP poll (INBOX only, no flags, no UID validity): new messages by UIDL
    (or by message number), then deletes of stored UIDLs the server no longer lists.

    ``folders`` holds the folders whose listing is complete; deletes run even when
    the mailbox is empty (reference rule).
    """
    plan = folders.select("folder_uri", F.lit(KIND_POP).alias("kind"), F.lit(MODE_INCREMENTAL).alias("mode"),
                          F.lit(False).alias("clear_first"), F.lit(None).cast("bigint").alias("_mark"))
    changes = poll_changes(stored, _non_null(listing, POP_KEY), plan, version, switches, by_number)
    return changes.select(*listing.columns, "op", "version", "seq")
