"""Raw message sources (S1, S3): landed messages as a table of bytes.

* a Parquet landing table ``(account, folder_uri, uid | pop_id, ..., raw BINARY)``;
* ``.eml`` trees through Spark's ``binaryFile`` source (file splits replace the
  reference's message-number slices);
* ``raw_from_documents``: test messages built natively from the ``documents``
  table, used by the parse queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailframe.sources.tables import read_table


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages (``folder_uri``, ``uid`` and / or ``pop_id``, ``raw``), by preference partitioned by ``fbucket``."""
    return spark.read.parquet(path)


def read_eml_tree(spark: SparkSession, path: str, glob: str = "*.eml") -> DataFrame:
    """One row per file: ``path``, ``raw``; the folder is the parent directory."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return df.select(
        "path",
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder_uri"),
        F.col("content").alias("raw"),
    )


# Fixture rules for messages built from documents.
UNKNOWN_CHARSET_EVERY = 7  # declares a charset no decoder knows -> null text
TOO_DEEP_EVERY = 13  # nested 101 multiparts deep -> error row
NEST_LEVELS = 101
CRLF = "\r\n"


def _b64_word(text_col) -> F.Column:
    return F.concat(F.lit("=?UTF-8?B?"), F.regexp_replace(F.base64(F.encode(text_col, "UTF-8")), "[\r\n]", ""), F.lit("?="))


def sent_ts_from_doc(doc_id_col="doc_id") -> F.Column:
    return F.timestamp_add("MINUTE", F.col(doc_id_col), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def raw_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw message per document (whole text), built with native string functions."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    doc = F.col("doc_id")
    charset = F.when(doc % UNKNOWN_CHARSET_EVERY == 0, F.lit("x-unknown-charset")).otherwise(F.lit("utf-8"))
    date_hdr = F.concat(F.date_format(sent_ts_from_doc(), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    body_b64 = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), "[\r\n]", "")
    head = F.concat(
        F.lit("From: "), _b64_word(F.concat(F.lit("Sénder "), F.col("source"))),
        F.lit(" <sender"), (doc % 50).cast("string"), F.lit("@example.com>" + CRLF),
        F.lit('To: "Reader One" <r1@example.com>, '), F.col("lang"), F.lit("-list@example.com" + CRLF),
        F.lit("Subject: "), _b64_word(F.concat(F.lit("Über "), doc.cast("string"), F.lit(" ("), F.col("lang"), F.lit(")"))),
        F.lit(CRLF),
        F.lit("Date: "), date_hdr, F.lit(CRLF),
        F.lit("Message-ID: <"), doc.cast("string"), F.lit("@example.com>" + CRLF),
        F.lit("MIME-Version: 1.0" + CRLF),
    )
    simple = F.concat(
        F.lit('Content-Type: text/plain; charset="'), charset, F.lit('"' + CRLF),
        F.lit("Content-Transfer-Encoding: base64" + CRLF + CRLF), body_b64, F.lit(CRLF),
    )
    levels = F.sequence(F.lit(0), F.lit(NEST_LEVELS - 1))
    opening = F.array_join(F.transform(levels, lambda i: F.concat(
        F.lit("--b"), i.cast("string"), F.lit(CRLF + 'Content-Type: multipart/mixed; boundary="b'),
        (i + 1).cast("string"), F.lit('"' + CRLF + CRLF))), "")
    closing = F.array_join(F.transform(F.reverse(levels), lambda i: F.concat(
        F.lit(CRLF + "--b"), i.cast("string"), F.lit("--"))), "")
    nested = F.concat(
        F.lit('Content-Type: multipart/mixed; boundary="b0"' + CRLF + CRLF),
        opening,
        F.lit("--b" + str(NEST_LEVELS) + CRLF + "Content-Type: text/plain; charset=utf-8" + CRLF + CRLF),
        F.col("text"),
        F.lit(CRLF + "--b" + str(NEST_LEVELS) + "--"),
        closing,
        F.lit(CRLF),
    )
    raw = F.concat(head, F.when(doc % TOO_DEEP_EVERY == 0, nested).otherwise(simple))
    return d.select(
        doc.cast("string").alias("message_id"),
        F.concat(F.lit("imap://reader%40example.com@mail.example.com/"), F.col("lang")).alias("folder_uri"),
        F.encode(raw, "UTF-8").alias("raw"),
    )
