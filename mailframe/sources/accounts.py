"""Accounts and their target tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailframe.options import DEFAULT_INDEX_NAME, DEFAULT_PROTOCOL


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """Settings files (JSON objects, one per file) as rows."""
    return spark.read.option("multiLine", "true").json(path)


def accounts_from_settings(settings: DataFrame, user: str = "user", users: str = "users",
                           id_col: str | None = None) -> DataFrame:
    """``user`` first (unless null or empty), then the non-null entries of ``users``, in order."""
    first = F.when(_c(user).isNotNull() & (_c(user) != ""), F.array(_c(user))).otherwise(F.array().cast("array<string>"))
    rest = F.filter(F.coalesce(_c(users), F.array().cast("array<string>")), lambda x: x.isNotNull())
    keep = [id_col] if id_col else []
    return settings.select(*keep, F.posexplode(F.concat(first, rest)).alias("pos", "account"))


def accounts_from_directory(export: DataFrame, dn: str = "dn", name_attr: str = "name",
                            master: str | None = None) -> DataFrame:
    """Directory export -> logins.

    Entries without the name attribute are dropped (the ``attr=*`` filter); the
    login is the value of the first RDN of the entry's DN; with a master user
    set the login becomes ``<login>*<master>``.
    """
    # Fixed value: separator between a login and the master user.
    master_sep = "*"
    first_rdn = F.substring_index(_c(dn), ",", 1)
    value = F.try_element_at(F.split(first_rdn, "="), F.lit(2))  # the text after the first '='
    login = F.concat(value, F.lit(master_sep + master)) if master else value
    # an entry whose name has no '=' yields no login
    return export.filter(_c(name_attr).isNotNull()).withColumn("login", login).filter(F.col("login").isNotNull())


def mailbox_kind(protocol: str | Column) -> Column:
    """A protocol containing 'imap' (any case) -> IMAP rules, otherwise POP; empty -> imaps."""
    p = F.lower(F.coalesce(F.nullif(_c(protocol), F.lit("")), F.lit(DEFAULT_PROTOCOL)))
    return F.when(p.contains("imap"), F.lit("IMAP")).otherwise(F.lit("POP"))


def index_name(strategy: Column | str, user: str | Column, base: str | Column = DEFAULT_INDEX_NAME) -> Column:
    """Target table per account; case-insensitive strategy, unknown -> base name.

    ``strategy`` is a literal strategy name or a column holding one per account.
    """
    s = F.lower(strategy if isinstance(strategy, Column) else F.lit(strategy))
    b = F.lit(base) if isinstance(base, str) else base
    u = _c(user)
    crop = F.split(u, "@").getItem(0)
    return (
        F.when(s == "all_in_one", b)
        .when(s == "username", u)
        .when(s == "username_crop", crop)
        .when(s == "prefixed_username", F.concat(b, F.lit("-"), u))
        .when(s == "prefixed_username_crop", F.concat(b, F.lit("-"), crop))
        .otherwise(b)
    )
