"""Filters, lookups and counts over stored documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailframe.functions import text as tx
from mailframe.operators import search, sync
from mailframe.plans.registry import register
from mailframe.sources import fixtures as fx
from mailframe.sources.fixtures import with_views
from mailframe.sources.tables import read_table

TERM_FOLDER = "imap://user1%40example.com@mail.example.com/purchase"
SMALL_HASHES = list(range(0, 64, 3))


@register("term_terms_bool", with_views("mailbox", "stored", "server") + f""",
changed AS (SELECT s.folder_uri, s.uid FROM server s JOIN stored t ON s.folder_uri = t.folder_uri AND s.uid = t.uid
            WHERE s.flaghashcode <> t.flaghashcode)
SELECT m.uid, m.folder_uri, m.flaghashcode FROM mailbox m
WHERE m.folder_uri = '{TERM_FOLDER}'
  AND m.flaghashcode IN ({", ".join(map(str, SMALL_HASHES))})
  AND EXISTS (SELECT 1 FROM changed c WHERE c.folder_uri = m.folder_uri AND c.uid = m.uid)""")
def term_terms_bool(spark, sf_dir):
    """Q20 (F5, F6, F7): term AND terms-by-list AND terms-by-table."""
    mb = fx.mailbox(spark, sf_dir).select("uid", "folder_uri", "flaghashcode")
    changed = sync.flag_changes(fx.server(spark, sf_dir).select("folder_uri", "uid", "flaghashcode"),
                                fx.stored(spark, sf_dir)).select("folder_uri", "uid")
    return search.bool_must(
        mb,
        search.term("folder_uri", TERM_FOLDER),
        search.terms("flaghashcode", SMALL_HASHES),
        table_terms=[(changed, ["folder_uri", "uid"])],
    )


@register("first_hit", with_views("mailbox") + f"""
SELECT uid, folder_uri FROM mailbox WHERE folder_uri = '{TERM_FOLDER}' ORDER BY uid LIMIT 1""")
def first_hit(spark, sf_dir):
    """L1: the first hit of a search, made deterministic by ordering on uid (a top-1 report)."""
    mb = fx.mailbox(spark, sf_dir).select("uid", "folder_uri")
    return search.first_hits(mb.filter(search.term("folder_uri", TERM_FOLDER)), "uid", 1)


@register("flaghash_lookup", with_views("stored", "server") + """
SELECT s.folder_uri, s.uid, t.flaghashcode AS stored_flaghashcode
FROM server s LEFT JOIN stored t ON s.folder_uri = t.folder_uri AND s.uid = t.uid""")
def flaghash_lookup(spark, sf_dir):
    """S8 bulk form: stored flag hash per listed message; null = not stored."""
    listing = fx.server(spark, sf_dir).select("folder_uri", "uid")
    return search.lookup(listing, fx.stored(spark, sf_dir), ["folder_uri", "uid"], "flaghashcode",
                         "stored_flaghashcode")


@register("counts_by_index", with_views("mailbox") + """
SELECT account AS index_name, 'mail' AS type_name, count(*) AS n_docs FROM mailbox GROUP BY account""")
def counts_by_index(spark, sf_dir):
    """Q21 (A1, F9): document count per (index, type)."""
    mb = fx.mailbox(spark, sf_dir).select(F.col("account").alias("index_name"), F.lit("mail").alias("type_name"))
    return search.count_by(mb, ["index_name", "type_name"], "n_docs")


@register("count_over_indices", with_views("mailbox") + """
SELECT count(*) AS n_docs FROM mailbox WHERE account IN ('user0@example.com', 'user2@example.com')""")
def count_over_indices(spark, sf_dir):
    """Q21 (A2): one count over several indices."""
    mb = fx.mailbox(spark, sf_dir).select(F.col("account").alias("index_name"))
    return search.count_where(mb, search.terms("index_name", ["user0@example.com", "user2@example.com"]), "n_docs")


MATCH_QUERY = "schen"
PHRASE_QUERY = "of the"


@register("match", f"""
SELECT doc_id FROM documents
WHERE list_has_any(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), ['{MATCH_QUERY}'])""")
def match(spark, sf_dir):
    """Q22 (F10): documents holding any token of the query."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.filter(tx.match("text", MATCH_QUERY)).select("doc_id")


@register("match_phrase", f"""
SELECT doc_id FROM documents
WHERE ' ' || array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> ''), ' ') || ' '
      LIKE '% {PHRASE_QUERY} %'""")
def match_phrase(spark, sf_dir):
    """Q22 (F11): documents holding the query tokens consecutively and in order."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.filter(tx.match_phrase("text", PHRASE_QUERY)).select("doc_id")


@register("token_counts", """
SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')) AS INTEGER) AS n_tokens
FROM documents""")
def token_counts(spark, sf_dir):
    """F10 analysis: token count of every whole document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.size(tx.tokens("text")).alias("n_tokens"))
