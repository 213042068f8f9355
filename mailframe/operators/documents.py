"""Parsed messages + listing metadata -> mail documents (the store's row shape) and error rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailframe.functions import document as doc
from mailframe.functions.keys import doc_id, mailbox_type
from mailframe.options import MailOptions


def to_documents(parsed: DataFrame, options: MailOptions = MailOptions(), carry: list[str] = ()) -> DataFrame:
    """Project parsed rows (P1 output + ``folder_uri``, ``folder_full_name``, ``uid``,
    ``pop_id``, ``flags_bits``, ``user_flags``, ``received_date``) to documents.

    Switches (P21) change the projection list, so unused columns are never computed.
    Without ``flags_bits`` the listing's ``flaghashcode`` and ``flags`` are kept as they are.  ``carry``
    columns pass through unchanged.
    """
    ok = parsed.filter(F.col("error").isNull())
    cols = {c: (F.col(c) if c in parsed.columns else F.lit(None)) for c in
            ("uid", "pop_id", "folder_uri", "folder_full_name", "received_date", "flags_bits", "user_flags")}
    uid = F.coalesce(cols["uid"].cast("bigint"), F.lit(0).cast("bigint"))
    pop = cols["pop_id"].cast("string")
    text = F.col("text_content")
    if options.with_striptags_from_textcontent:
        text = doc.strip_tags(text)
    out = [
        doc_id(uid, pop, cols["folder_uri"]).alias("doc_id"),
        uid.alias("uid"),
        pop.alias("popId"),
        mailbox_type(pop).alias("mailboxType"),
        cols["folder_full_name"].cast("string").alias("folderFullName"),
        cols["folder_uri"].cast("string").alias("folderUri"),
        F.col("content_type").alias("contentType"),
        F.col("subject"),
        F.col("size"),
        F.col("sent_date").alias("sentDate"),
        cols["received_date"].cast("timestamp_ntz").alias("receivedDate"),
        F.col("from"),
        F.col("to"),
        F.col("cc"),
        F.col("bcc"),
        doc.distinct_headers("headers").alias("headers"),
        (text if options.with_text_content else F.lit(None).cast("string")).alias("textContent"),
        (F.col("html_content") if options.with_html_content else F.lit(None).cast("string")).alias("htmlContent"),
    ]
    if "flaghashcode" in parsed.columns and "flags_bits" not in parsed.columns:
        names = F.col("flags") if "flags" in parsed.columns else F.lit(None)
        out += [names.cast("array<string>").alias("flags"), F.col("flaghashcode").cast("int").alias("flaghashcode")]
    else:  # no flags known -> no flag set
        bits = F.coalesce(cols["flags_bits"].cast("bigint"), F.lit(0).cast("bigint"))
        user = cols["user_flags"] if "user_flags" in parsed.columns else None
        out += [doc.flag_names(bits, user).alias("flags"), doc.flag_hash(bits, user).alias("flaghashcode")]
    out += [F.col(c) for c in carry]
    if options.with_attachments:
        atts = doc.attachments("parts")
        out += [atts.alias("attachments"), doc.attachment_count(atts).alias("attachmentCount")]
    else:
        out += [F.lit(0).alias("attachmentCount")]
    docs = ok.select(*out)
    if options.headers_to_fields:
        docs = docs.select("*", *doc.selected_headers("headers", list(options.headers_to_fields)))
    return docs


def error_rows(parsed: DataFrame, key_col: str = "message_id") -> DataFrame:
    """K8 / P20: one row per message that failed to parse."""
    return parsed.filter(F.col("error").isNotNull()).select(
        F.col(key_col).cast("string").alias("message_id"),
        F.col("folder_uri"),
        F.col("error").alias("error_msg"),
    )


MISSING_RAW = "the raw message has not landed"


def fetch_raw(ups: DataFrame, raw: DataFrame, keys: list[str]) -> DataFrame:
    """Messages of ``ups`` that have raw bytes, by an inner join that leaves the large side where it lies.

    ``ups`` is a written table, so the planner knows its size: as long as that is below
    ``spark.sql.autoBroadcastJoinThreshold`` the few keys go to the raw rows, which are neither
    shuffled nor sorted; beyond, Spark shuffles both and a bloom filter of the keys thins the raw rows first.
    """
    return raw.select(*keys, "raw").join(ups, keys, "inner").select(*ups.columns, "raw")


def fetch_documents(changes: DataFrame, raw: DataFrame, options: MailOptions = MailOptions(),
                    keys: list[str] = ("folder_uri", "uid"), *, stage) -> tuple[DataFrame, DataFrame]:
    """Upsert change rows -> their raw bytes -> parsed documents, plus error rows.

    The reference re-reads the whole message for new and flag-changed messages; here
    that is one equi-join of the upserts with the raw landing table on the message
    key, then the parse stage.  Only upsert rows cross to Python.  A message whose raw
    bytes have not landed gives an error row of kind ``missing``, which later polls
    take up again.  ``stage`` writes the upserts, and the parsed rows, once for all that read them.
    """
    from mailframe.operators.parse import parse_messages
    from mailframe.operators.store import folder_bucket
    from mailframe.operators.sync import OP_UPSERT

    keys = list(keys)
    ups = stage(changes.filter(F.col("op") == OP_UPSERT))
    if "fbucket" in raw.columns:
        # A landing partitioned by folder bucket is read only where this poll has new messages
        # (at most FOLDER_BUCKETS values).
        buckets = sorted(r[0] for r in ups.select(folder_bucket().alias("b")).distinct().collect())
        raw = raw.filter(F.col("fbucket").isin(buckets))
    # The raw rows of a poll may lie in few files or few parts of them, and parsing costs far more than moving
    # them: they are dealt by key, four tasks to a core (merged by size, the last few would run alone).
    found = fetch_raw(ups, raw, keys).repartition(4 * ups.sparkSession.sparkContext.defaultParallelism, *keys)
    keep = ups.columns
    parsed = stage(parse_messages(found, keep=keep, with_text=options.with_text_content,
                                  with_html=options.with_html_content, prefer_html=options.prefer_html_content,
                                  with_attachments=options.with_attachments))
    carry = [c for c in ("op", "version", "seq", "account", "index_name", "type_name", "pop_id") if c in keep]
    docs = to_documents(parsed, options, carry=carry).withColumnRenamed("folderUri", "folder_uri")
    pop = "pop_id" in keys
    key = F.col("pop_id") if pop else F.col("uid").cast("string")

    def error(rows: DataFrame, message, kind: str) -> DataFrame:
        return rows.select(
            F.concat(key, F.lit("::"), F.col("folder_uri")).alias("message_id"),
            "folder_uri",
            message.alias("error_msg"),
            (F.lit(None) if pop else F.col("uid")).cast("bigint").alias("uid"),
            (F.col("pop_id") if pop else F.lit(None)).cast("string").alias("pop_id"),
            F.lit(kind).alias("kind"))

    missing = ups.join(parsed.select(*keys), keys, "left_anti")
    errors = error(parsed.filter(F.col("error").isNotNull()), F.col("error"), "parse").unionByName(error(missing, F.lit(MISSING_RAW), "missing"))
    return docs, errors


def export_json(docs: DataFrame) -> DataFrame:
    """One JSON text per document, as the store receives it.

    Dates use the export format, selected ``header_*`` fields sit at top level, bytes
    are unbroken base64, null fields are written.
    """
    date_cols = {"sentDate", "receivedDate"}
    fields = []
    for c in docs.columns:
        if c == "doc_id":
            continue
        if c in date_cols:
            fields.append(doc.export_date(c).alias(c))
        elif c == "attachments":
            fields.append(F.transform(c, lambda a: F.struct(
                doc.base64_unbroken(a["content"]).alias("content"), a["contentType"].alias("contentType"),
                a["filename"].alias("filename"), a["name"].alias("name"), a["size"].alias("size"))).alias(c))
        else:
            fields.append(F.col(c))
    return docs.select("doc_id", doc.document_json(*fields).alias("json"))
