"""Corpus pipeline: language ID, exact dedup, near-duplicate join, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its
result is written as Parquet and read again as the next stage's documents.  All stages but
the last return the columns of ``documents``; from the first stage on ``lang`` is the language
found in the text, not the given one, and no packed sequence mixes languages.  A row is addressed by its doc_id and text, so
rows that share an id are judged apart; a null id is an id like any other and comes after all
others.  Repeated rows count as copies; of equal texts and ties the named id stays; texts may
have any length; other columns of the input, whatever their names, are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailframe.llm import cuckoo, decontam, jaccard_join, langid, packing
from mailframe.llm.common import scratch_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no learned language: null text, text without a letter, and text whose n-grams the labelled sample does not know.

    The others get the predicted language as ``lang``, which decides with which documents they are packed."""
    model = langid.fit(docs.select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text"))
    return langid.with_language(docs.select(COLUMNS), model, "text", "lang")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, once."""

    def key(digest: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), digest)

    kept = cuckoo.exact_dedup(docs).filter("kept").select(key(F.col("text_sha256")).alias("key")).distinct()
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    rows = docs.select(*COLUMNS, key(digest).alias("key")).join(kept, "key", "left_semi")
    return rows.dropDuplicates(["key"]).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 or more the one with the least doc_id stays."""
    return jaccard_join.one_of_each(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go; rows that share an id are judged apart."""
    return decontam.without_leaks(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, each of one language, with the digest of their ids."""
    pieces = packing.pack(docs, packing.tokenizer_path(), group_col="lang")
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL expresses neither the kernel classifier nor the token sequences; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to shared storage and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
