"""Message -> document projections as native column expressions.

All of these run inside the JVM (higher-order functions over arrays), so they stay
out of Python and apply to whole texts without any per-row Python call.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailframe.functions.keys import java_string_hash

# JavaMail system flag bits (public API) and the order in which
# the document lists flag names.
FLAG_ANSWERED = 1
FLAG_DELETED = 2
FLAG_DRAFT = 4
FLAG_FLAGGED = 8
FLAG_RECENT = 16
FLAG_SEEN = 32
FLAG_USER = 0x80000000
FLAG_NAME_ORDER = [
    ("Deleted", FLAG_DELETED),
    ("Answered", FLAG_ANSWERED),
    ("Draft", FLAG_DRAFT),
    ("Flagged", FLAG_FLAGGED),
    ("Recent", FLAG_RECENT),
    ("Seen", FLAG_SEEN),
]

# Fixed value: the export date format of a document.
EXPORT_DATE_FORMAT = "yyyyMMdd'T'HHmmss.SSS"
EXPORT_ZONE_SUFFIX = "+0000"

# Fixed value: tag pattern removed from text content (dot does not cross a line end).
STRIP_TAGS_PATTERN = "<.*?>"

HEADER = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])
ADDRESS = T.StructType([T.StructField("email", T.StringType()), T.StructField("personal", T.StringType())])


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P2 ------------------------------------------------------------------------

def distinct_headers(headers: str | Column) -> Column:
    """Headers distinct by name (case-sensitive), first occurrence kept, message order kept."""
    empty = F.array().cast(T.ArrayType(HEADER))
    return F.aggregate(
        _c(headers),
        empty,
        lambda acc, h: F.when(F.exists(acc, lambda y: y["name"] == h["name"]), acc).otherwise(
            F.array_append(acc, h)
        ),
    )


# P3 ------------------------------------------------------------------------

def header_field_name(header_name: str) -> str:
    """'header_' + name with every char outside [A-Za-z0-9 ] replaced by '_', lower-cased.

    Spaces are kept (the code's rule, not the manual's)."""
    return "header_" + re.sub(r"[^A-Za-z0-9 ]", "_", header_name).lower()


def selected_header(headers: str | Column, header_name: str) -> Column:
    """Value of the first header whose name equals ``header_name`` ignoring case; null if none."""
    wanted = header_name.lower()
    hits = F.filter(_c(headers), lambda h: F.lower(h["name"]) == F.lit(wanted))
    return F.try_element_at(hits, F.lit(1))["value"]


def selected_headers(headers: str | Column, names: list[str]) -> list[Column]:
    """One column per configured header name, in configured order."""
    return [selected_header(headers, n).alias(header_field_name(n)) for n in names]


def has_header(headers: str | Column, name: str, value_like: str) -> Column:
    """F12 nested predicate: one header element has this name (any case) and a matching value."""
    return F.exists(_c(headers), lambda h: (F.lower(h["name"]) == F.lit(name.lower())) & h["value"].like(value_like))


# P7 / P8 -------------------------------------------------------------------

def first_address(addresses: str | Column) -> Column:
    """``from`` keeps only the first From address."""
    return F.try_element_at(_c(addresses), F.lit(1))


def all_recipients(to: str | Column, cc: str | Column, bcc: str | Column) -> Column:
    empty = F.array().cast(T.ArrayType(ADDRESS))
    return F.concat(F.coalesce(_c(to), empty), F.coalesce(_c(cc), empty), F.coalesce(_c(bcc), empty))


# P11 -----------------------------------------------------------------------

def strip_tags(text: str | Column) -> Column:
    """Delete ``<...>`` runs that do not cross a line end; null stays null."""
    return F.regexp_replace(_c(text), STRIP_TAGS_PATTERN, "")


# P13-P15 -------------------------------------------------------------------

def is_attachment(part: Column) -> Column:
    """Disposition 'attachment' (any case) or a non-blank file name."""
    disp = F.coalesce(F.lower(part["disposition"]) == F.lit("attachment"), F.lit(False))
    named = F.coalesce(part["filename"].rlike(r"\S"), F.lit(False))  # not blank: some non-whitespace char
    return disp | named


def attachments(parts: str | Column) -> Column:
    """Top-level parts that are attachments, as (content, contentType, filename, name, size); null if none."""
    picked = F.transform(
        F.filter(_c(parts), is_attachment),
        lambda p: F.struct(
            p["content"].alias("content"),
            p["content_type"].alias("contentType"),
            p["filename"].alias("filename"),
            p["filename"].alias("name"),
            F.octet_length(p["content"]).alias("size"),
        ),
    )
    return F.when(F.size(picked) > 0, picked)


def attachment_count(atts: str | Column) -> Column:
    """0 when there is no attachment (the array is null then)."""
    return F.when(_c(atts).isNull(), F.lit(0)).otherwise(F.size(_c(atts)))


def base64_unbroken(content: str | Column) -> Column:
    """Base64 text without line breaks (as the JSON export writes bytes)."""
    return F.regexp_replace(F.base64(_c(content)), "[\r\n]", "")


# P16 / P17 -----------------------------------------------------------------

def flag_names(system_flags: str | Column, user_flags: str | Column | None = None) -> Column:
    """System flag names in fixed order, then user flags only when the USER bit is set."""
    bits = _c(system_flags).cast("bigint")
    names = F.array_compact(
        F.array(*[F.when(bits.bitwiseAND(F.lit(b)) != 0, F.lit(n)) for n, b in FLAG_NAME_ORDER])
    )
    if user_flags is None:
        return names
    user_on = bits.bitwiseAND(F.lit(FLAG_USER)) != 0
    return F.when(user_on, F.concat(names, F.coalesce(_c(user_flags), F.array().cast("array<string>")))).otherwise(names)


def flag_hash(system_flags: str | Column, user_flags: str | Column | None = None) -> Column:
    """Flags hash: system bits plus the Java string hash of each lower-cased user flag, as a 32-bit int."""
    total = _c(system_flags).cast("bigint")
    if user_flags is not None:
        hashes = F.transform(F.coalesce(_c(user_flags), F.array().cast("array<string>")),
                             lambda f: java_string_hash(F.lower(f)).cast("bigint"))
        total = total + F.aggregate(hashes, F.lit(0).cast("bigint"), lambda a, x: a + x)
    wrapped = F.pmod(total, F.lit(4294967296))
    return F.when(wrapped >= 2147483648, wrapped - 4294967296).otherwise(wrapped).cast("int")


# P19 / K9 ------------------------------------------------------------------

def export_date(ts: str | Column) -> Column:
    """Document date text ``yyyyMMdd'T'HHmmss.SSSZ`` for a UTC timestamp."""
    t = _c(ts).cast("timestamp_ntz")
    return F.when(t.isNotNull(), F.concat(F.date_format(t, EXPORT_DATE_FORMAT), F.lit(EXPORT_ZONE_SUFFIX)))


def document_json(*cols: Column) -> Column:
    """JSON text of a document with nulls written (the reference writes null fields)."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
