"""Schemas of the mail document and the side tables."""

from __future__ import annotations

from pyspark.sql import types as T

HEADER = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])
HEADERS = T.ArrayType(HEADER)
ADDRESS = T.StructType([T.StructField("email", T.StringType()), T.StructField("personal", T.StringType())])
ADDRESSES = T.ArrayType(ADDRESS)
PART = T.StructType([
    T.StructField("content_type", T.StringType()),
    T.StructField("disposition", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("content", T.BinaryType()),
])
PARTS = T.ArrayType(PART)
ATTACHMENT = T.StructType([
    T.StructField("content", T.BinaryType()),
    T.StructField("contentType", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("size", T.IntegerType()),
])

MAIL = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("index_name", T.StringType()),
    T.StructField("attachmentCount", T.IntegerType()),
    T.StructField("attachments", T.ArrayType(ATTACHMENT)),
    T.StructField("from", ADDRESS),
    T.StructField("to", ADDRESSES),
    T.StructField("cc", ADDRESSES),
    T.StructField("bcc", ADDRESSES),
    T.StructField("contentType", T.StringType()),
    T.StructField("flaghashcode", T.IntegerType()),
    T.StructField("flags", T.ArrayType(T.StringType())),
    T.StructField("folderFullName", T.StringType()),
    T.StructField("folderUri", T.StringType()),
    T.StructField("headers", HEADERS),
    T.StructField("mailboxType", T.StringType()),
    T.StructField("popId", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("receivedDate", T.TimestampNTZType()),
    T.StructField("sentDate", T.TimestampNTZType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("subject", T.StringType()),
    T.StructField("textContent", T.StringType()),
    T.StructField("htmlContent", T.StringType()),
])

LISTING = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("folder_full_name", T.StringType()),
    T.StructField("folder_uri", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("pop_id", T.StringType()),
    T.StructField("msg_num", T.IntegerType()),
    T.StructField("flaghashcode", T.IntegerType()),
    T.StructField("received_date", T.TimestampNTZType()),
])

FOLDER_STATE = T.StructType([
    T.StructField("index_name", T.StringType()),
    T.StructField("folder_uri", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("exists", T.BooleanType()),
    T.StructField("uid_validity", T.LongType()),
    T.StructField("last_uid", T.LongType()),
    T.StructField("last_count", T.LongType()),
    T.StructField("last_took", T.LongType()),  # milliseconds of the poll that last touched the folder
    T.StructField("last_indexed", T.TimestampType()),
    T.StructField("last_schedule", T.TimestampType()),
])

#: Numbered listing snapshots: per account the one applied last, and those above it that are still due.
SNAPSHOT_STATE = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("snapshot_id", T.LongType()),
    T.StructField("applied", T.BooleanType()),
    T.StructField("want", T.LongType()),  # rows that the writer announced; null until the row that says so has landed
    T.StructField("have", T.LongType()),  # rows landed so far (landed copies count each)
    T.StructField("since", T.LongType()),  # version of the batch that brought its first row
])

POLL_METRICS = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("index_name", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("folder_uri", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("n_listed", T.LongType()),
    T.StructField("n_new", T.LongType()),
    T.StructField("n_flags", T.LongType()),
    T.StructField("n_deleted", T.LongType()),
    T.StructField("cleared", T.BooleanType()),
])

MAIL_ERRORS = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("folder_uri", T.StringType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("pop_id", T.StringType()),
    T.StructField("kind", T.StringType()),  # "parse", or "missing": the raw bytes had not landed
])
