"""Parse queries (Q01, Q18): raw messages built from ``documents`` go through the parse stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailframe.functions import document as doc
from mailframe.operators.documents import error_rows as error_rows_of
from mailframe.operators.parse import RECURSION_ERROR, parse_messages
from mailframe.plans.registry import register
from mailframe.sources.raw import TOO_DEEP_EVERY, UNKNOWN_CHARSET_EVERY, raw_from_documents


def _parsed(spark, sf_dir):
    raw = raw_from_documents(spark, sf_dir)
    return parse_messages(raw, keep=["message_id", "folder_uri"])


@register("parse_round_trip", f"""
SELECT CAST(doc_id AS VARCHAR) AS message_id,
       'Über ' || CAST(doc_id AS VARCHAR) || ' (' || lang || ')' AS subject,
       CASE WHEN doc_id % {UNKNOWN_CHARSET_EVERY} = 0 THEN NULL
            ELSE regexp_replace(text, '<[^\\n\\r\\x{{85}}\\x{{2028}}\\x{{2029}}]*?>', '', 'g') END AS text_content,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (doc_id) MINUTE, '%a, %d %b %Y %H:%M:%S') || ' +0000' AS date_header,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (doc_id) MINUTE AS sent_date,
       'sender' || CAST(doc_id % 50 AS VARCHAR) || '@example.com' AS from_email,
       'Sénder ' || source AS from_personal,
       CAST(2 AS INTEGER) AS n_to,
       'r1@example.com' AS first_to
FROM documents WHERE doc_id % {TOO_DEEP_EVERY} <> 0""")
def parse_round_trip(spark, sf_dir):
    """Q01 (S1, P1, P7, P12, P11): subject, stripped text, raw Date, sender and recipients of each message."""
    p = _parsed(spark, sf_dir).filter(F.col("error").isNull())
    return p.select(
        "message_id",
        "subject",
        doc.strip_tags("text_content").alias("text_content"),
        doc.selected_header("headers", "Date").alias("date_header"),
        "sent_date",
        F.col("from.email").alias("from_email"),
        F.col("from.personal").alias("from_personal"),
        F.size("to").alias("n_to"),
        F.try_element_at("to", F.lit(1))["email"].alias("first_to"),
    )


@register("error_rows", f"""
SELECT CAST(doc_id AS VARCHAR) AS message_id,
       'imap://reader%40example.com@mail.example.com/' || lang AS folder_uri,
       '{RECURSION_ERROR}' AS error_msg
FROM documents WHERE doc_id % {TOO_DEEP_EVERY} = 0""")
def error_rows(spark, sf_dir):
    """Q18 (K8, P20): messages that failed to parse are recorded, the rest goes on."""
    return error_rows_of(_parsed(spark, sf_dir))


@register("mail_documents", f"""
SELECT 'imap://reader%40example.com@mail.example.com/' || lang AS folderUri,
       CAST(doc_id AS VARCHAR) || '::imap://reader%40example.com@mail.example.com/' || lang AS doc_id,
       CAST(doc_id AS BIGINT) AS uid,
       'IMAP' AS mailboxType,
       'Über ' || CAST(doc_id AS VARCHAR) || ' (' || lang || ')' AS subject,
       CAST(8 AS INTEGER) AS n_headers,
       '<' || CAST(doc_id AS VARCHAR) || '@example.com>' AS header_message_id,
       CAST(NULL AS VARCHAR) AS header_x_none,
       CAST(0 AS INTEGER) AS attachmentCount,
       CASE WHEN doc_id % 2 = 0 THEN 'Seen' ELSE '' END AS flags,
       CAST(CASE WHEN doc_id % 2 = 0 THEN 32 ELSE 0 END AS INTEGER) AS flaghashcode,
       CASE WHEN doc_id % {UNKNOWN_CHARSET_EVERY} = 0 THEN NULL
            ELSE CAST(length(regexp_replace(text, '<[^\\n\\r\\x{{85}}\\x{{2028}}\\x{{2029}}]*?>', '', 'g')) AS INTEGER) END AS text_length
FROM documents WHERE doc_id % {TOO_DEEP_EVERY} <> 0""")
def mail_documents(spark, sf_dir):
    """P1 -> P2..P21: parsed messages plus listing metadata assembled into store documents."""
    from mailframe.operators.documents import to_documents
    from mailframe.options import MailOptions

    raw = raw_from_documents(spark, sf_dir).withColumns({
        "uid": F.col("message_id").cast("bigint"),
        "folder_full_name": F.regexp_extract("folder_uri", "([^/]+)$", 1),
        "flags_bits": F.when(F.col("message_id").cast("bigint") % 2 == 0, F.lit(32)).otherwise(F.lit(0)),
    })
    parsed = parse_messages(raw, keep=["message_id", "folder_uri", "uid", "folder_full_name", "flags_bits"])
    opts = MailOptions(headers_to_fields=("Message-ID", "X-None"))
    docs = to_documents(parsed, opts)
    return docs.select(
        "folderUri", "doc_id", "uid", "mailboxType", "subject",
        F.size("headers").alias("n_headers"),
        "header_message_id", "header_x_none", "attachmentCount",
        F.array_join("flags", ",").alias("flags"), "flaghashcode",
        F.length("textContent").alias("text_length"),
    )
