"""Benchmark decontamination by templates, in DataFrame functions only.

Texts become templates: numbers, units behind a number and names (capitalised words inside
a sentence) are replaced by typed placeholders.  Windows of ``WINDOW`` template tokens of
benchmark items are hash-joined with the windows of all documents.  Windows that lie on one
diagonal (document position minus item position) belong together; there the slots are
compared: an item's value must always stand for one and the same value of the document.
A document leaks an item if a run of successive matching windows of a diagonal, consistent with
each other, has as many windows as the item or ``MIN_RUN``; other windows of the diagonal may be in conflict with them.

Items also have windows in which names are words like any other, and documents' windows are
matched in both forms.  Case, white space and the words around tell names wrongly, but not
this form, so a copy is found whatever they are.  The forms of an item are judged apart.

Windows with fewer than ``MIN_WORDS`` literal words fit too much as templates.  In the form
with names as words they match by their values, so that exact copies of numbers are found.

Window hashes are built by doubling: a window of 8 is two windows of 4, and so on.  Before
anything is joined, a document's windows are held against a table of ``FILTER_SLOTS`` residues of the items'
hashes, a scalar of fixed size; the few that pass are joined with the items' windows on the
hash itself, so the table decides nothing, and a large benchmark only lets more windows pass.

Defined results: null or empty text never leaks; items shorter than a window are one window
of their own length; repeated items and documents each count; a null id is an id like any
other; rows are told apart by id and text, so a clean row that shares its id with a leaking
one stays clean; of equally long runs the first counts; texts may have any length; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import scratch_table

WINDOW = 8
#: Windows of a run that make a leak even when the item is longer (13 template tokens).
MIN_RUN = 6
#: Words that are not placeholders which a window of an item needs to match as a template.
MIN_WORDS = 4
#: Residues of a hash that the filter of item windows tells apart; a power of two.
FILTER_SLOTS = 1 << 20

NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
#: Units of measure, recognised behind a number.
UNITS = (
    "km cm mm m kg g mg lb lbs oz l ml km/h mph s sec seconds min minutes h hours day days week weeks month months year years "
    "dollars euros cents usd eur percent miles feet inches meters metres degrees"
).split()


_WORD = rf"a-z0-9_{NUMBER}{NAME}{UNIT}\p{{L}}\p{{M}}"  # what a lower-cased token holds


def marked(text: Column) -> Column:
    """Text with every number, unit and name prefixed by its type's mark, lower-cased, words parted by one space."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?<=[0-9])[.,:/](?=[0-9])", "_")
    out = F.regexp_replace(out, r"[0-9][0-9_]*", f" {NUMBER}$0 ")
    out = F.regexp_replace(out, rf"(?i)({NUMBER}[0-9_]+[ \t-\r]+)({'|'.join(UNITS)})([^\p{{L}}\p{{M}}0-9_]|$)", f"$1{UNIT}$2$3")
    out = F.regexp_replace(out, r"(?<=[\p{Ll}0-9,;:])[ \t-\r]+(?=\p{Lu})", f" {NAME}")
    return F.trim(F.regexp_replace(F.lower(out), rf"[^a-z0-9_{NUMBER}{NAME}{UNIT}\p{{L}}\p{{M}}]+", " "))


def _is_slot(word: Column) -> Column:
    return word < F.lit("\x04")  # words begin with a letter or a digit, so only marks come before


def _named(word: Column) -> Column:
    return _is_slot(word) & word.startswith(NAME)


def value(word: Column) -> Column:
    """A marked word with its value, names as the words they are."""
    return F.when(_named(word), F.substring(word, 2, 1 << 30)).otherwise(word)


def token(word: Column, form: int) -> Column:
    """What a marked word is in a template: a slot's mark, or the word; in form 1 names are words."""
    slot = F.substring(word, 1, 1)
    if form == 1:
        slot = F.when(word.startswith(NAME), F.substring(word, 2, 1 << 30)).otherwise(slot)
    return F.when(_is_slot(word), slot).otherwise(word)


def _text_key(id_col: str, text_col: str) -> Column:
    """A row's key: its id and 128 bits of its text's hash; rows that share both leak alike."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.struct(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def _let(value: Column, body) -> Column:
    """``body`` over a value computed once per row; a plain column would be computed anew for each array element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _joined(left: Column, right: Column, ahead: int) -> Column:
    """Hash of each element of ``left`` with the one of ``right`` that is ``ahead`` places on; the last ones have no partner and mean nothing."""
    return F.zip_with(left, F.slice(right, F.lit(ahead + 1), F.size(right)), lambda a, b: F.xxhash64(a, b))


def _spans(words: Column, read, sizes: list[int], body) -> Column:
    """``body`` over {size: array of the hashes of all windows of so many words (as ``read``), one for each word}; those that reach over the end mean nothing."""

    def doubled(have: dict[int, Column], width: int) -> Column:
        if 2 * width <= max(sizes):
            return _let(_joined(have[width], have[width], width), lambda wide: doubled(have | {2 * width: wide}, 2 * width))
        out = {}
        for size in sizes:
            at = 1 << (size.bit_length() - 1)
            hashes = have[at]
            while at < size:
                more = 1 << ((size - at).bit_length() - 1)
                hashes, at = _joined(hashes, have[more], at), at + more
            out[size] = hashes
        return body(out)

    return _let(F.transform(words, lambda w: F.xxhash64(read(w))), lambda ones: doubled({1: ones}, 1))


def _token_reader(form: int):
    return lambda word: token(word, form)


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, form, by_value, size, hash, item_pos, item_slots, item_windows) of every benchmark item; form: 0 with names as slots, 1 with names as words."""
    rows = items.select(F.col(id_col).cast("bigint").alias("item"), marked(F.col(text_col)).alias("marks")).filter("marks != ''")
    rows = rows.select("item", F.split("marks", " ").alias("words"), F.explode(F.array(F.lit(0), F.lit(1))).alias("form"))
    first = F.col("form") == 0
    words = F.col("words")
    tokens = F.transform(words, lambda w: F.when(first, token(w, 0)).otherwise(token(w, 1)))
    values = F.transform(words, lambda w: F.when(first, w).otherwise(value(w)))
    rows = rows.select("item", "form", tokens.alias("tokens"), values.alias("values"))
    tokens, values = F.col("tokens"), F.col("values")
    sizes = list(range(1, WINDOW + 1))

    def windows(by_token: dict[int, Column], by_value: dict[int, Column]) -> Column:
        def of(size: int) -> Column:
            def one(i: Column) -> Column:
                words = F.size(F.filter(F.slice(tokens, i, size), lambda t: ~t.isin(NUMBER, NAME, UNIT)))
                few = words < MIN_WORDS
                return F.struct(
                    F.lit(size).alias("size"), i.alias("item_pos"), few.alias("by_value"), F.when(few, F.get(by_value[size], i - 1)).otherwise(F.get(by_token[size], i - 1)).alias("hash"),
                    F.when(words < size, F.array_join(F.slice(values, i, size), " ")).alias("item_slots"),
                )

            return F.transform(F.sequence(F.lit(1), F.size(tokens) - size + 1), one)

        own = F.least(F.lit(WINDOW), F.size(tokens))
        return F.coalesce(*(F.when(own == size, of(size)) for size in sizes))

    each = rows.withColumn("w", _spans(tokens, lambda t: t, sizes, lambda t: _spans(values, lambda v: v, sizes, lambda v: windows(t, v))))
    kept = each.select("item", "form", F.inline("w")).filter("NOT by_value OR form = 1")
    kept = scratch_table(kept, "decontam-items")  # read more than once
    totals = kept.groupBy("item", "form").agg(F.countDistinct("item_pos").alias("item_windows"))
    same = kept["item"].eqNullSafe(totals["item"]) & (kept["form"] == totals["form"])
    return kept.dropDuplicates(["item", "form", "item_pos", "hash"]).join(totals, same).drop(totals["item"], totals["form"])


def _filter(wanted: DataFrame) -> Column:
    """Which ``FILTER_SLOTS`` residues of a hash any item's window has, as a scalar of as many bytes."""
    there = bytearray(FILTER_SLOTS)
    for r in wanted.select(F.col("hash").bitwiseAND(F.lit(FILTER_SLOTS - 1)).alias("slot")).distinct().toLocalIterator():  # FILTER_SLOTS rows at most
        there[max(0, r["slot"] - 1)] = 1  # substring() takes place 0 for 1
    # A scalar of a written table: as a literal it would stand in every plan's text that the driver keeps.
    return scratch_table(wanted.sparkSession.createDataFrame([(there,)], "there binary"), "decontam-filter").scalar()


def _candidates(words: Column, wanted: list[tuple], there: Column) -> Column:
    """array<struct<size, pos, hash, slots>>: windows whose hash may be an item's; slots: the window with its values.

    ``wanted``: (how words are read, sizes of the windows).
    """

    def passing(spans: Column, size: int) -> Column:
        def one(h: Column, i: Column) -> Column:
            may = F.substring(there, h.bitwiseAND(F.lit(FILTER_SLOTS - 1)).cast("int"), 1) > F.lit(bytearray(1))
            window = F.struct(F.lit(size).alias("size"), (i + 1).alias("pos"), h.alias("hash"), F.array_join(F.slice(words, i + 1, size), " ").alias("slots"))
            return F.when(may, F.when(i <= F.size(words) - size, window))

        return F.filter(F.transform(spans, one), lambda w: w.isNotNull())

    found = [_spans(words, read, sizes, lambda spans: F.concat(*(passing(h, n) for n, h in spans.items()))) for read, sizes in wanted if sizes]
    return F.concat(*found) if found else F.array().cast(_WINDOWS)


def _pairs(item_slots: Column, doc_slots: Column) -> Column:
    """array<struct<i, d>>: the distinct values in the same place of two windows, with their marks."""
    pairs = F.arrays_zip(F.split(item_slots, " ").alias("i"), F.split(doc_slots, " ").alias("d"))
    return F.array_distinct(F.filter(pairs, lambda p: p["i"].rlike(f"^[{NUMBER}{NAME}{UNIT}]")))


def _longest_run(hits: Column) -> Column:
    """struct<windows, pairs>: the longest run of successive hits in which each item value stands for one document value; the first of equally long ones."""
    values = "array<struct<i:string,d:string,at:int>>"
    start = F.struct(F.lit(1).alias("start"), F.lit(0).alias("at"), F.lit(1).alias("first"), F.lit(0).alias("length"), F.array().cast(values).alias("seen"))

    def add(run: Column, hit: Column) -> Column:
        pairs, at = hit["pairs"], run["at"] + 1
        clash = F.filter(run["seen"], lambda s: F.exists(pairs, lambda p: (p["i"] == s["i"]) & (p["d"] != s["d"])))
        torn = F.size(F.array_distinct(F.transform(pairs, lambda p: p["i"]))) < F.size(pairs)  # in conflict with itself
        begin = F.greatest(run["start"], F.coalesce(F.array_max(F.transform(clash, lambda s: s["at"])) + 1, F.lit(1)), F.when(torn, at + 1).otherwise(F.lit(1)))
        others = F.filter(run["seen"], lambda s: ~F.exists(pairs, lambda p: (p["i"] == s["i"]) & (p["d"] == s["d"])))
        seen = F.concat(others, F.transform(pairs, lambda p: F.struct(p["i"].alias("i"), p["d"].alias("d"), at.alias("at"))))
        longer = at - begin + 1 > run["length"]
        return F.struct(
            begin.alias("start"), at.alias("at"), F.when(longer, begin).otherwise(run["first"]).alias("first"),
            F.when(longer, at - begin + 1).otherwise(run["length"]).alias("length"), seen.alias("seen"),
        )

    def best(run: Column) -> Column:
        inside = F.slice(hits, run["first"], run["length"])
        return F.struct(run["length"].alias("windows"), F.array_distinct(F.flatten(F.transform(inside, lambda h: h["pairs"]))).alias("pairs"))

    return _let(F.aggregate(hits, start, add), best)


_PAIRS = "array<struct<i:string,d:string>>"
_WINDOWS = "array<struct<size:int,pos:int,hash:bigint,slots:string>>"


def _row_leaks(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every leaked item of every row: (leaking: the row's key, item_id, start, windows, item_windows, slots, changed_slots)."""
    wanted = scratch_table(item_windows(items), "decontam-windows")
    kinds = wanted.select("form", "by_value", "size").distinct().collect()  # at most 3 * WINDOW rows
    sizes = lambda form, by_value: sorted({r["size"] for r in kinds if r["form"] in form and r["by_value"] == by_value})
    def found(marks: Column, there: Column) -> Column:
        # Windows without a name are the same in both forms, so the one with names as words finds them for both.
        plain = [(_token_reader(1), sizes((0, 1), False)), (value, sizes((1,), True))]
        every = _let(F.split(marks, " "), lambda words: _candidates(words, plain, there))
        named = _let(F.split(marks, " "), lambda words: _candidates(words, [(_token_reader(0), sizes((0,), False))], there))
        return F.when(marks != "", F.concat(every, F.when(marks.contains(NAME), named).otherwise(F.array().cast(_WINDOWS))))

    # The scalar has a projection of its own as the analyser wants it; the optimiser makes the two one, so that no row holds it.
    rows = docs.select(_text_key(id_col, text_col).alias("leaking"), F.col(text_col).alias("text"), _filter(wanted).alias("there"))
    each = _let(F.col("there"), lambda there: _let(marked(F.col("text")), lambda marks: found(marks, there)))
    hits = rows.select("leaking", each.alias("w")).select("leaking", F.inline_outer("w")).join(wanted, ["size", "hash"])
    hits = hits.withColumn("pairs", F.coalesce(_pairs(F.col("item_slots"), F.col("slots")), F.array().cast(_PAIRS)))
    hit = F.struct(F.col("item_pos").alias("pos"), "pairs")
    runs = hits.groupBy("leaking", "item", "form", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(
        F.sort_array(F.collect_set(hit)).alias("hits"), F.first("item_windows").alias("item_windows")
    )
    need = F.least(F.col("item_windows"), F.lit(MIN_RUN))
    runs = runs.filter(F.size("hits") >= need).withColumn("best", _longest_run(F.col("hits")))
    return runs.filter(F.col("best.windows") >= need).select(
        "leaking",
        F.col("item").alias("item_id"),
        (F.col("diagonal") + 1).alias("start"),
        F.col("best.windows").alias("windows"),
        "item_windows",
        F.size("best.pairs").alias("slots"),
        F.size(F.filter("best.pairs", lambda p: p["i"] != p["d"])).alias("changed_slots"),
    )


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start, windows, item_windows, slots, changed_slots): every leaked item of every document."""
    return _row_leaks(docs, items, id_col, text_col).withColumn("doc_id", F.col("leaking.id")).select("doc_id", "item_id", "start", "windows", "item_windows", "slots", "changed_slots")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item."""
    found = _row_leaks(docs, items, id_col, text_col).select(F.struct("leaking").alias("leak_row")).distinct()
    return docs.join(found, _same_row(id_col, text_col, found["leak_row"]["leaking"]), "left_anti")


def _same_row(id_col: str, text_col: str, key: Column) -> Column:
    return _same_key(_text_key(id_col, text_col), key)


def _same_key(own: Column, key: Column) -> Column:
    return own["id"].eqNullSafe(key["id"]) & (own["h1"] == key["h1"]) & (own["h2"] == key["h2"])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per input document: (doc_id, leaked, n_items, item_id, reparameterised); item_id is the least leaked item."""
    found = _row_leaks(docs, items, "doc_id", "text").groupBy("leaking").agg(
        F.countDistinct("item_id").alias("n_items"), F.min("item_id").alias("item_id"), (F.max("changed_slots") > 0).alias("reparameterised")
    )
    rows = docs.select(_text_key("doc_id", "text").alias("own"))  # the key alone is shuffled, not the text
    joined = rows.join(found, _same_key(F.col("own"), found["leaking"]), "left")
    return joined.select(
        F.col("own.id").alias("doc_id"),
        F.col("n_items").isNotNull().alias("leaked"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        "item_id",
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"),
    )


def _sql() -> str:
    marks = "coalesce(text, '')"
    for _ in range(2):  # a digit can end one match and begin the next
        marks = rf"regexp_replace({marks}, '([0-9])[.,:/]([0-9])', '\1_\2', 'g')"
    marks = rf"regexp_replace({marks}, '[0-9][0-9_]*', ' ' || chr(1) || '\0 ', 'g')"
    marks = rf"regexp_replace({marks}, '(?i)(' || chr(1) || '[0-9_]+[ \t-\r]+)({'|'.join(UNITS)})([^\p{{L}}\p{{M}}0-9_]|$)', '\1' || chr(3) || '\2\3', 'g')"
    marks = rf"regexp_replace({marks}, '([\p{{Ll}}0-9,;:])[ \t-\r]+(\p{{Lu}})', '\1 ' || chr(2) || '\2', 'g')"
    marks = rf"trim(regexp_replace(lower({marks}), '[^\p{{L}}\p{{M}}0-9_' || chr(1) || chr(2) || chr(3) || ']+', ' ', 'g'))"
    return rf"""
WITH src AS (
  SELECT side, id, form, CASE form WHEN 0 THEN m ELSE replace(m, chr(2), '') END AS m
  FROM (SELECT side, id, {marks} AS m FROM (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark)), range(2) f(form)),
tok AS (
  SELECT side, id, form, string_split(m, ' ') AS vals,
    string_split(regexp_replace(m, '([' || chr(1) || chr(2) || chr(3) || '])[^ ]+', '\1', 'g'), ' ') AS toks FROM src WHERE m <> ''),
sizes AS (SELECT DISTINCT least({WINDOW}, len(toks)) AS size FROM tok WHERE side = 'i'),
win AS (
  SELECT side, id, form, size, pos, list_slice(toks, pos, pos + size - 1) AS t, list_slice(vals, pos, pos + size - 1) AS v
  FROM (SELECT side, id, form, size, toks, vals, unnest(range(1, len(toks) - size + 2)) AS pos
    FROM tok, sizes WHERE len(toks) >= size AND (side = 'd' OR size = least({WINDOW}, len(toks))))),
keyed AS (
  SELECT *, CASE WHEN few THEN v ELSE t END AS key
  FROM (SELECT *, len(list_filter(t, lambda x: x NOT IN (chr(1), chr(2), chr(3)))) < {MIN_WORDS} AS few, list_contains(t, chr(2)) AS has_name FROM win)),
items AS (SELECT DISTINCT id AS item, form, size, pos AS item_pos, key, v FROM keyed WHERE side = 'i' AND (NOT few OR form = 1)),
totals AS (SELECT item, form, count(DISTINCT item_pos) AS item_windows FROM items GROUP BY ALL),
hits AS (
  SELECT DISTINCT d.id AS doc, i.item, i.form, d.pos - i.item_pos AS diagonal, i.item_pos,
    list_distinct(list_filter(list_zip(i.v, d.v), lambda p: p[1][1] IN (chr(1), chr(2), chr(3)))) AS pairs
  FROM keyed d JOIN items i ON d.key = i.key WHERE d.side = 'd' AND (d.form = 1 OR (d.has_name AND NOT d.few))),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc, item, form, diagonal ORDER BY item_pos) AS j FROM hits),
slots AS (SELECT doc, item, form, diagonal, j, p[1] AS i, p[2] AS d FROM (SELECT *, unnest(pairs) AS p FROM placed)),
begins AS (
  SELECT b.doc, b.item, b.form, b.diagonal, b.j, max(CASE WHEN a.j = b.j THEN b.j + 1 ELSE a.j + 1 END) AS s
  FROM slots a JOIN slots b ON a.doc = b.doc AND a.item = b.item AND a.form = b.form AND a.diagonal = b.diagonal AND a.i = b.i AND a.d <> b.d AND a.j <= b.j
  GROUP BY ALL),
runs AS (
  SELECT doc, item, form, diagonal, j, max(coalesce(s, 1)) OVER (PARTITION BY doc, item, form, diagonal ORDER BY j) AS s
  FROM placed LEFT JOIN begins USING (doc, item, form, diagonal, j)),
best AS (
  SELECT *, j - s + 1 AS windows FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc, item, form, diagonal ORDER BY j - s DESC, j) = 1),
ok AS (
  SELECT b.doc, b.item, bool_or(coalesce(x.i <> x.d, false)) AS changed
  FROM best b JOIN totals t USING (item, form)
  LEFT JOIN slots x ON x.doc = b.doc AND x.item = b.item AND x.form = b.form AND x.diagonal = b.diagonal AND x.j BETWEEN b.s AND b.j
  WHERE b.windows >= least(t.item_windows, {MIN_RUN}) GROUP BY ALL),
found AS (SELECT doc, count(DISTINCT item) AS n_items, min(item) AS item_id, bool_or(changed) AS reparameterised FROM ok GROUP BY doc)
SELECT d.doc_id, f.doc IS NOT NULL AS leaked, coalesce(f.n_items, 0) AS n_items, f.item_id, coalesce(f.reparameterised, false) AS reparameterised
FROM documents d LEFT JOIN found f ON d.doc_id = f.doc
"""


LEAK_SQL = _sql()
