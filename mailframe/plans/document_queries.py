"""Document projection queries (Q02-Q09, Q08f, Q17, Q19) over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailframe.functions import document as doc
from mailframe.functions.keys import doc_id, key_from_doc_id, mailbox_type, uid_from_doc_id
from mailframe.operators.folders import folder_tree, select_folders
from mailframe.operators.text_choice import choose_text
from mailframe.plans.registry import register
from mailframe.sources import accounts as acc
from mailframe.sources import fixtures as fx
from mailframe.sources.fixtures import with_views
from mailframe.sources.tables import read_table


def duck_java_hash_u32(expr: str) -> str:
    """DuckDB form of the Java string hash, as an unsigned 32-bit value in BIGINT."""
    return (f"list_reduce([0::BIGINT] || list_transform(string_split({expr}, ''), lambda c: ascii(c)::BIGINT), "
            f"lambda a, x: (a * 31 + x) % 4294967296)")


def duck_signed32(expr: str) -> str:
    return f"CAST(CASE WHEN ({expr}) >= 2147483648 THEN ({expr}) - 4294967296 ELSE ({expr}) END AS INTEGER)"


# Q02 -----------------------------------------------------------------------
# Fixture: five raw headers per document, one name repeated, one case variant.
SELECTED = ["X-LANG", "x-source", "Message-ID", "X-Missing"]


def _doc_headers():
    h = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    return F.array(
        h("X-Lang", F.col("lang")),
        h("X-Source", F.col("source")),
        h("x-lang", F.upper("lang")),
        h("X-Source", F.concat(F.lit("dup-"), F.col("source"))),
        h("Message-ID", F.concat(F.lit("<"), F.col("doc_id").cast("string"), F.lit("@example.com>"))),
    )


@register("selected_headers", """
WITH h AS (
  SELECT doc_id, 1 AS pos, 'X-Lang' AS name, lang AS value FROM documents
  UNION ALL SELECT doc_id, 2, 'X-Source', source FROM documents
  UNION ALL SELECT doc_id, 3, 'x-lang', upper(lang) FROM documents
  UNION ALL SELECT doc_id, 4, 'X-Source', 'dup-' || source FROM documents
  UNION ALL SELECT doc_id, 5, 'Message-ID', '<' || CAST(doc_id AS VARCHAR) || '@example.com>' FROM documents),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, name ORDER BY pos) AS rn FROM h) WHERE rn = 1)
SELECT doc_id,
       CAST(count(*) AS INTEGER) AS n_headers,
       string_agg(name, ',' ORDER BY pos) AS header_names,
       arg_min(value, pos) FILTER (WHERE lower(name) = 'x-lang') AS header_x_lang,
       arg_min(value, pos) FILTER (WHERE lower(name) = 'x-source') AS header_x_source,
       arg_min(value, pos) FILTER (WHERE lower(name) = 'message-id') AS header_message_id,
       arg_min(value, pos) FILTER (WHERE lower(name) = 'x-missing') AS header_x_missing,
       coalesce(bool_or(lower(name) = 'x-lang' AND value LIKE 'EN'), false) AS nested_hit
FROM d GROUP BY doc_id""")
def selected_headers(spark, sf_dir):
    """Q02 (P2, P3, F12): distinct headers, configured headers as fields, nested predicate."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    with_h = docs.select("doc_id", doc.distinct_headers(_doc_headers()).alias("headers"))
    return with_h.select(
        "doc_id",
        F.size("headers").alias("n_headers"),
        F.array_join(F.transform("headers", lambda h: h["name"]), ",").alias("header_names"),
        *doc.selected_headers("headers", SELECTED),
        doc.has_header("headers", "x-lang", "EN").alias("nested_hit"),
    )


# Q03 -----------------------------------------------------------------------

@register("document_ids", with_views("mailbox", "pop_server") + """
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id, 'IMAP' AS mailbox_type,
       CAST(uid AS VARCHAR) AS doc_key, uid AS key_uid, folder_uri FROM mailbox
UNION ALL
SELECT pop_id || '::' || folder_uri, 'POP', pop_id, TRY_CAST(pop_id AS BIGINT), folder_uri FROM pop_server""")
def document_ids(spark, sf_dir):
    """Q03 (P4, P5, P6, S6): document ids of IMAP and POP messages and the key read back from them."""
    imap = fx.mailbox(spark, sf_dir).select("uid", F.lit(None).cast("string").alias("pop_id"), "folder_uri")
    pop = fx.pop_server(spark, sf_dir).select(F.lit(0).cast("bigint").alias("uid"), "pop_id", "folder_uri")
    rows = imap.unionByName(pop).withColumn("doc_id", doc_id("uid", "pop_id", "folder_uri"))
    return rows.select(
        "doc_id",
        mailbox_type("pop_id").alias("mailbox_type"),
        key_from_doc_id("doc_id").alias("doc_key"),
        uid_from_doc_id("doc_id").alias("key_uid"),
        "folder_uri",
    )


# Q04 -----------------------------------------------------------------------

def _customer_addresses(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    a = lambda e, p: F.struct(e.alias("email"), p.cast("string").alias("personal"))
    to = F.array(
        a(F.concat(F.lower("c_mktsegment"), F.lit("@example.com")), F.col("c_name")),
        a(F.concat(F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("@example.com")), F.lit(None)),
    )
    acct = (F.col("c_custkey") % 97).cast("string")
    cc = F.array(a(F.concat(F.lit("acct"), acct, F.lit("@example.com")), F.concat(F.lit("Account "), acct)))
    bcc = F.when(F.col("c_acctbal") < 0, F.array(a(F.lit("audit@example.com"), F.lit(None))))
    return c.select("c_custkey", to.alias("to"), cc.alias("cc"), bcc.alias("bcc"))


@register("distinct_recipients", """
WITH r AS (
  SELECT lower(c_mktsegment) || '@example.com' AS email, c_name AS personal FROM customer
  UNION ALL SELECT 'nation' || CAST(c_nationkey AS VARCHAR) || '@example.com', NULL FROM customer
  UNION ALL SELECT 'acct' || CAST(c_custkey % 97 AS VARCHAR) || '@example.com', 'Account ' || CAST(c_custkey % 97 AS VARCHAR) FROM customer
  UNION ALL SELECT 'audit@example.com', NULL FROM customer WHERE c_acctbal < 0)
SELECT email, min(personal) AS personal, count(*) AS n_occurrences FROM r GROUP BY email""")
def distinct_recipients(spark, sf_dir):
    """Q04 (P7, P8): recipients distinct by email (personal ignored for equality)."""
    m = _customer_addresses(spark, sf_dir)
    r = m.select(F.explode(doc.all_recipients("to", "cc", "bcc")).alias("a")).select("a.email", "a.personal")
    return r.groupBy("email").agg(F.min("personal").alias("personal"), F.count(F.lit(1)).alias("n_occurrences"))


@register("first_sender", """
SELECT c_custkey, lower(c_mktsegment) || '@example.com' AS from_email, c_name AS from_personal,
       CAST(CASE WHEN c_acctbal < 0 THEN 4 ELSE 3 END AS INTEGER) AS n_recipients
FROM customer""")
def first_sender(spark, sf_dir):
    """``from`` keeps only the first address; recipient count over to/cc/bcc."""
    m = _customer_addresses(spark, sf_dir)
    first = doc.first_address("to")
    return m.select(
        "c_custkey",
        first["email"].alias("from_email"),
        first["personal"].alias("from_personal"),
        F.size(doc.all_recipients("to", "cc", "bcc")).alias("n_recipients"),
    )


# Q05 -----------------------------------------------------------------------

def _conversation_parts(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")  # every turn: the user's is plain, the others html
    return conv.select(
        F.col("conv_id").alias("message_id"),
        F.col("turn").alias("pos"),
        F.when(F.col("role") == "user", F.lit("text/plain")).otherwise(F.lit("text/html")).alias("mime"),
        "text",
    )


@register("text_choice", """
SELECT conv_id AS message_id,
       coalesce(arg_min(text, turn) FILTER (WHERE role = 'user' AND text IS NOT NULL),
                arg_min(text, turn) FILTER (WHERE role <> 'user' AND text IS NOT NULL)) AS text_content
FROM conversations GROUP BY conv_id""")
def text_choice(spark, sf_dir):
    """Q05 (P9): plain text preferred in a multipart/alternative message."""
    return choose_text(_conversation_parts(spark, sf_dir), prefer_html=False)


@register("html_choice", """
SELECT conv_id AS message_id, arg_min(text, turn) FILTER (WHERE role <> 'user') AS html_content
FROM conversations GROUP BY conv_id""")
def html_choice(spark, sf_dir):
    """Q05 (P10): html preferred; a plain-only message gives null (reference rule)."""
    return choose_text(_conversation_parts(spark, sf_dir), prefer_html=True, out_col="html_content")


# Q06 -----------------------------------------------------------------------

@register("strip_tags", r"""
SELECT page_id, regexp_replace(html, '<[^\n\r\x{85}\x{2028}\x{2029}]*?>', '', 'g') AS text_content FROM pages""")
def strip_tags(spark, sf_dir):
    """Q06 (P11): tags removed from whole pages."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", doc.strip_tags("html").alias("text_content"))


# Q07 -----------------------------------------------------------------------

def _document_parts():
    p = lambda ct, disp, fn, content: F.struct(
        F.lit(ct).alias("content_type"),
        F.lit(disp).cast("string").alias("disposition"),
        fn.cast("string").alias("filename"),
        content.alias("content"),
    )
    return F.array(
        p("text/plain", "inline", F.lit(None), F.encode("text", "UTF-8")),
        p("application/octet-stream", "attachment", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt")),
          F.encode("text", "UTF-8")),
        p("text/plain", "ATTACHMENT", F.lit(None), F.encode("lang", "UTF-8")),
        p("text/plain", "inline", F.lit("   "), F.encode("source", "UTF-8")),
        p("text/plain", None, F.concat(F.lit("notes-"), F.col("source"), F.lit(".txt")), F.encode("source", "UTF-8")),
    )


@register("attachments", """
SELECT doc_id,
       CAST(3 AS INTEGER) AS attachment_count,
       CAST(octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source)) AS BIGINT) AS attachments_size,
       'doc' || CAST(doc_id AS VARCHAR) || '.txt||notes-' || source || '.txt' AS attachment_names,
       to_base64(encode(text)) AS content_b64,
       contains(to_base64(encode(text)), 'ZSB') AS source_hit
FROM documents""")
def attachments(spark, sf_dir):
    """Q07 (P13, P14, P15, F13): attachments of a multipart message built per document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    a = docs.select("doc_id", doc.attachments(_document_parts()).alias("atts"))
    b64 = doc.base64_unbroken(F.element_at("atts", 1)["content"])
    return a.select(
        "doc_id",
        doc.attachment_count("atts").alias("attachment_count"),
        F.aggregate("atts", F.lit(0).cast("bigint"), lambda s, x: s + x["size"]).alias("attachments_size"),
        F.array_join(F.transform("atts", lambda x: F.coalesce(x["filename"], F.lit(""))), "|").alias("attachment_names"),
        b64.alias("content_b64"),
        b64.contains("ZSB").alias("source_hit"),
    )


# Q08f ----------------------------------------------------------------------

def _message_flags(mb):
    """Fixture flags: bits from ``flaghashcode``, USER bit on even UIDs, user flags on UIDs divisible by 3."""
    system = F.col("flaghashcode").cast("bigint") + F.when(F.col("uid") % 2 == 0, F.lit(doc.FLAG_USER)).otherwise(F.lit(0))
    user = F.when(F.col("uid") % 3 == 0, F.array(F.concat(F.lit("Label"), (F.col("uid") % 7).cast("string")), F.lit("Urgent"))) \
        .otherwise(F.array().cast("array<string>"))
    return mb.select("uid", "folder_uri", system.alias("system_flags"), user.alias("user_flags"))


_FLAG_NAMES_SQL = " || ".join(
    f"CASE WHEN (flaghashcode & {b}) <> 0 THEN '{n},' ELSE '' END" for n, b in doc.FLAG_NAME_ORDER
)


@register("flag_names", with_views("mailbox") + f""",
f AS (SELECT uid, folder_uri, flaghashcode,
             ({_FLAG_NAMES_SQL}) ||
             CASE WHEN uid % 2 = 0 AND uid % 3 = 0 THEN 'Label' || CAST(uid % 7 AS VARCHAR) || ',Urgent,' ELSE '' END AS s
      FROM mailbox)
SELECT uid, folder_uri, CASE WHEN s = '' THEN '' ELSE s[1:length(s) - 1] END AS flag_names FROM f""")
def flag_names(spark, sf_dir):
    """Q08f (P16): flag names in fixed order; user flags only with the USER bit."""
    f = _message_flags(fx.mailbox(spark, sf_dir))
    return f.select("uid", "folder_uri", F.array_join(doc.flag_names("system_flags", "user_flags"), ",").alias("flag_names"))


@register("flag_hash", with_views("mailbox") + f""",
f AS (SELECT uid, folder_uri,
             CAST(flaghashcode AS BIGINT) + CASE WHEN uid % 2 = 0 THEN 2147483648 ELSE 0 END
             + CASE WHEN uid % 3 = 0 THEN {duck_java_hash_u32("'label' || CAST(uid % 7 AS VARCHAR)")}
                                        + {duck_java_hash_u32("'urgent'")} ELSE 0 END AS t
      FROM mailbox)
SELECT uid, folder_uri, {duck_signed32("t % 4294967296")} AS flag_hash FROM f""")
def flag_hash(spark, sf_dir):
    """Q08f (P17): the flags hash that detects flag changes."""
    f = _message_flags(fx.mailbox(spark, sf_dir))
    return f.select("uid", "folder_uri", doc.flag_hash("system_flags", "user_flags").alias("flag_hash"))


# Q09 -----------------------------------------------------------------------
# Fixture: folder paths are host/path of page URLs; a folder holds messages when
# the length of its full name is not divisible by 3.
FOLDER_PATTERN = r".*\.(com|org)(/(en|de|fr)(/[0-9]*[02468])?)?"


def _page_folders(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    paths = pages.select(F.regexp_extract("url", r"^[A-Za-z]+://([^?#]*)", 1).alias("folder_full_name"))
    paths = paths.filter(F.length("folder_full_name") > 0)
    tree = folder_tree(paths)
    return tree.select("folder_full_name", (F.length("folder_full_name") % 3 != 0).alias("holds_messages"))


@register("folder_selection", r"""
WITH p AS (SELECT regexp_extract(url, '^[A-Za-z]+://([^?#]*)', 1) AS path FROM pages),
parts AS (SELECT string_split(path, '/') AS pa FROM p WHERE length(path) > 0),
tree AS (SELECT DISTINCT array_to_string(pa[1:d], '/') AS folder_full_name
         FROM parts, unnest(range(1, len(pa) + 1)) AS t(d)),
f AS (SELECT folder_full_name, length(folder_full_name) % 3 <> 0 AS holds_messages,
             regexp_full_match(folder_full_name, '.*\.(com|org)(/(en|de|fr)(/[0-9]*[02468])?)?') AS matches
      FROM tree),
blk AS (SELECT folder_full_name FROM f WHERE holds_messages AND NOT matches),
pr AS (SELECT DISTINCT f.folder_full_name FROM f JOIN blk
       ON starts_with(f.folder_full_name, blk.folder_full_name || '/'))
SELECT f.folder_full_name, f.holds_messages, f.matches,
       pr.folder_full_name IS NOT NULL AS pruned,
       f.holds_messages AND f.matches AND pr.folder_full_name IS NULL AS selected
FROM f LEFT JOIN pr ON f.folder_full_name = pr.folder_full_name""")
def folder_selection(spark, sf_dir):
    """Q09 (S5, S12, F1, F3, F4): folders a poll opens under a full-match pattern."""
    return select_folders(_page_folders(spark, sf_dir), FOLDER_PATTERN)


# Q17 -----------------------------------------------------------------------
# The strategy names the reference accepts, plus odd spellings the
# fixture uses to check case-insensitivity and the fallback.
STRATEGIES = ["all_in_one", "username", "USERNAME_CROP", "prefixed_username",
              "Prefixed_Username_Crop", "no_such_strategy", "username_crop"]
PROTOCOLS = ["imaps", "pop3s", "", "IMAP"]


def _customer_accounts(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    user = F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com"))
    strategy = F.element_at(F.array(*[F.lit(s) for s in STRATEGIES]), (F.col("c_custkey") % len(STRATEGIES) + 1).cast("int"))
    protocol = F.element_at(F.array(*[F.lit(p) for p in PROTOCOLS]), (F.col("c_nationkey") % len(PROTOCOLS) + 1).cast("int"))
    return c.select("c_custkey", user.alias("account"), strategy.alias("strategy"), protocol.alias("protocol"))


def _sql_list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@register("accounts_routing", f"""
WITH a AS (SELECT c_custkey,
                  lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com' AS account,
                  {_sql_list(STRATEGIES)}[c_custkey % {len(STRATEGIES)} + 1] AS strategy,
                  {_sql_list(PROTOCOLS)}[c_nationkey % {len(PROTOCOLS)} + 1] AS protocol
           FROM customer)
SELECT c_custkey, account, strategy,
       CASE WHEN contains(lower(CASE WHEN protocol = '' THEN 'imaps' ELSE protocol END), 'imap')
            THEN 'IMAP' ELSE 'POP' END AS mailbox_type,
       CASE lower(strategy)
            WHEN 'all_in_one' THEN 'imapriverdata'
            WHEN 'username' THEN account
            WHEN 'username_crop' THEN split_part(account, '@', 1)
            WHEN 'prefixed_username' THEN 'imapriverdata-' || account
            WHEN 'prefixed_username_crop' THEN 'imapriverdata-' || split_part(account, '@', 1)
            ELSE 'imapriverdata' END AS index_name
FROM a""")
def accounts_routing(spark, sf_dir):
    """Q17 (S13, K10, Y10): mailbox kind and target table of every account."""
    a = _customer_accounts(spark, sf_dir)
    return a.select(
        "c_custkey", "account", "strategy",
        acc.mailbox_kind("protocol").alias("mailbox_type"),
        acc.index_name(F.col("strategy"), "account").alias("index_name"),
    )


@register("accounts_from_settings", """
WITH s AS (SELECT c_custkey, lower(replace(c_name, '#', '.')) || '@example.com' AS u FROM customer)
SELECT c_custkey, 0 AS pos, u AS account FROM s
UNION ALL SELECT c_custkey, 1, 'alt.' || u FROM s
UNION ALL SELECT c_custkey, 2, 'ops.' || u FROM s WHERE c_custkey % 2 = 0""")
def accounts_from_settings(spark, sf_dir):
    """``user`` then the non-null ``users[]`` entries, in order (null entries skipped)."""
    c = read_table(spark, sf_dir, "customer")
    u = F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com"))
    settings = c.select(
        "c_custkey",
        u.alias("user"),
        F.array(F.concat(F.lit("alt."), u), F.lit(None).cast("string"),
                F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("ops."), u))).alias("users"),
    )
    return acc.accounts_from_settings(settings, id_col="c_custkey")


@register("accounts_from_directory", """
SELECT c_custkey, lower(replace(c_name, '#', '')) || '*mailadmin' AS login
FROM customer WHERE c_acctbal >= 0""")
def accounts_from_directory(spark, sf_dir):
    """Logins from a directory export: entries with the name attribute, first RDN value, master suffix."""
    c = read_table(spark, sf_dir, "customer")
    export = c.select(
        "c_custkey",
        F.concat(F.lit("uid="), F.lower(F.regexp_replace("c_name", "#", "")), F.lit(",ou="), F.lower("c_mktsegment"),
                 F.lit(",dc=example,dc=com")).alias("dn"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
    )
    return acc.accounts_from_directory(export, master="mailadmin").select("c_custkey", "login")


# Q19 -----------------------------------------------------------------------

@register("document_json", with_views("mailbox") + f"""
SELECT CAST(uid AS VARCHAR) || '::' || folder_uri AS doc_id,
       CAST(json_object('uid', uid, 'folderFullName', folder_full_name, 'folderUri', folder_uri,
                        'flaghashcode', flaghashcode,
                        'flags', list_filter([{", ".join(f"CASE WHEN (flaghashcode & {b}) <> 0 THEN '{n}' END" for n, b in doc.FLAG_NAME_ORDER)}], lambda x: x IS NOT NULL),
                        'mailboxType', 'IMAP', 'popId', NULL,
                        'receivedDate', strftime(received_date, '%Y%m%dT%H%M%S.%g') || '+0000',
                        'sentDate', NULL) AS VARCHAR) AS json
FROM mailbox""")
def document_json(spark, sf_dir):
    """Q19 (K9, P19): the JSON text of each document, dates in the reference format, nulls written."""
    mb = fx.mailbox(spark, sf_dir)
    return mb.select(
        doc_id("uid", None, "folder_uri").alias("doc_id"),
        doc.document_json(
            F.col("uid"),
            F.col("folder_full_name").alias("folderFullName"),
            F.col("folder_uri").alias("folderUri"),
            F.col("flaghashcode"),
            doc.flag_names("flaghashcode").alias("flags"),
            mailbox_type(F.lit(None)).alias("mailboxType"),
            F.lit(None).cast("string").alias("popId"),
            doc.export_date("received_date").alias("receivedDate"),
            F.lit(None).cast("string").alias("sentDate"),
        ).alias("json"),
    )


def _conversation_parts_with_other(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    mime = (F.when(F.col("role") == "user", F.lit("text/plain"))
            .when(F.col("role") == "assistant", F.lit("text/html"))
            .otherwise(F.lit("text/x-system")))
    return conv.select(F.col("conv_id").alias("message_id"), F.col("turn").alias("pos"), mime.alias("mime"), "text")


_OTHER_SQL = """
WITH c AS (
  SELECT conv_id,
         min(turn) FILTER (WHERE role NOT IN ('user', 'assistant')) AS o_pos,
         arg_min(text, turn) FILTER (WHERE role NOT IN ('user', 'assistant')) AS o_text,
         min(turn) FILTER (WHERE role = 'user' AND text IS NOT NULL) AS p_pos,
         arg_min(text, turn) FILTER (WHERE role = 'user' AND text IS NOT NULL) AS p_text,
         min(turn) FILTER (WHERE role = 'assistant') AS h1_pos,
         arg_min(text, turn) FILTER (WHERE role = 'assistant') AS h1_text,
         arg_min(text, turn) FILTER (WHERE role = 'assistant' AND text IS NOT NULL) AS h_text
  FROM conversations GROUP BY conv_id)
"""


@register("text_choice_with_other", _OTHER_SQL + """
SELECT conv_id AS message_id,
       CASE WHEN p_pos IS NOT NULL AND (o_pos IS NULL OR p_pos < o_pos) THEN p_text
            WHEN o_pos IS NOT NULL THEN o_text ELSE h_text END AS text_content
FROM c""")
def text_choice_with_other(spark, sf_dir):
    """P9 rule 2: a part that is neither plain nor html (the system turns) ends the choice at once."""
    return choose_text(_conversation_parts_with_other(spark, sf_dir), prefer_html=False)


@register("html_choice_with_other", _OTHER_SQL + """
SELECT conv_id AS message_id,
       CASE WHEN h1_pos IS NOT NULL AND (o_pos IS NULL OR h1_pos < o_pos) THEN h1_text
            WHEN o_pos IS NOT NULL THEN o_text END AS html_content
FROM c""")
def html_choice_with_other(spark, sf_dir):
    """P10 with other parts: the first html part, unless another part type comes first."""
    return choose_text(_conversation_parts_with_other(spark, sf_dir), prefer_html=True, out_col="html_content")


START_FOLDER = "ththre.example.com"


@register("folder_selection_subtree", r"""
WITH p AS (SELECT regexp_extract(url, '^[A-Za-z]+://([^?#]*)', 1) AS path FROM pages),
parts AS (SELECT string_split(path, '/') AS pa FROM p WHERE length(path) > 0),
tree AS (SELECT DISTINCT array_to_string(pa[1:d], '/') AS folder_full_name
         FROM parts, unnest(range(1, len(pa) + 1)) AS t(d)),
f AS (SELECT folder_full_name, length(folder_full_name) % 3 <> 0 AS holds_messages,
             regexp_full_match(folder_full_name, '.*\.(com|org)(/(en|de|fr)(/[0-9]*[02468])?)?') AS matches
      FROM tree),
blk AS (SELECT folder_full_name FROM f WHERE holds_messages AND NOT matches),
pr AS (SELECT DISTINCT f.folder_full_name FROM f JOIN blk
       ON starts_with(f.folder_full_name, blk.folder_full_name || '/'))
SELECT f.folder_full_name
FROM f LEFT JOIN pr ON f.folder_full_name = pr.folder_full_name
WHERE f.holds_messages AND f.matches AND pr.folder_full_name IS NULL
  AND (f.folder_full_name = 'ththre.example.com' OR starts_with(f.folder_full_name, 'ththre.example.com/'))
  AND regexp_full_match('ththre.example.com', '.*\.(com|org)(/(en|de|fr)(/[0-9]*[02468])?)?')""")
def folder_selection_subtree(spark, sf_dir):
    """fetch(pattern, start folder): only the start folder's subtree is walked."""
    sel = select_folders(_page_folders(spark, sf_dir), FOLDER_PATTERN, start=START_FOLDER)
    return sel.filter(F.col("selected")).select("folder_full_name")
