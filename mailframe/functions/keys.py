"""Document keys and mailbox type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "::"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mailbox_type(pop_id: str | Column = "pop_id") -> Column:
    """P4: 'POP' when the message has a POP id, else 'IMAP'."""
    return F.when(_c(pop_id).isNotNull(), F.lit("POP")).otherwise(F.lit("IMAP"))


def doc_id(uid: str | Column = "uid", pop_id: str | Column | None = "pop_id", folder_uri: str | Column = "folder_uri") -> Column:
    """P5: (popId if non-empty else uid) + '::' + folderUri."""
    key = _c(uid).cast("string")
    if pop_id is not None:
        key = F.coalesce(F.nullif(_c(pop_id), F.lit("")), key)
    return F.concat(key, F.lit(KEY_SEPARATOR), _c(folder_uri))


def key_from_doc_id(doc: str | Column = "doc_id") -> Column:
    """The uid / pop id part of a document id (text before the first '::')."""
    return F.substring_index(_c(doc), KEY_SEPARATOR, 1)


def uid_from_doc_id(doc: str | Column = "doc_id") -> Column:
    """IMAP key parsed to a long; null when it is not a number."""
    return key_from_doc_id(doc).try_cast("bigint")


def java_string_hash(s: str | Column) -> Column:
    """Java ``String.hashCode`` of a string as a signed 32-bit int.

    Folds 31*h + unit over the UTF-16 units in BIGINT modulo 2^32 (ANSI mode makes
    INT overflow raise), then maps to the signed range.
    """
    units = F.hex(F.encode(_c(s), "UTF-16BE"))
    at = F.sequence(F.lit(1), F.length(units) - 3, F.lit(4))
    codes = F.when(units == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(at, lambda i: F.conv(F.substr(units, i, F.lit(4)), 16, 10).cast("bigint"))
    )
    h = F.aggregate(codes, F.lit(0).cast("bigint"), lambda acc, x: F.pmod(acc * 31 + x, F.lit(4294967296)))
    return F.when(h >= 2147483648, h - 4294967296).otherwise(h).cast("int")


def state_id(folder_uri: str | Column = "folder_uri") -> Column:
    """Row id of a folder-state document in reference form: 'folderstate_' + hash of the URL."""
    return F.concat(F.lit("folderstate_"), java_string_hash(folder_uri).cast("string"))
