"""Unit tests of the column functions against direct Python computations."""

import pytest
from pyspark.sql import functions as F

from mailframe.functions import document as doc
from mailframe.functions import text as tx
from mailframe.functions.keys import doc_id, java_string_hash, key_from_doc_id, mailbox_type, uid_from_doc_id
from mailframe.options import InvalidPattern, MailOptions, validate_pattern
from mailframe.operators.folders import full_match


def jhash(s: str) -> int:
    h = 0
    for ch in s:
        h = (31 * h + ord(ch)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def one(spark, col, row=None, schema=None):
    df = spark.createDataFrame([row or (1,)], schema or "x int")
    return df.select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("s", ["", "a", "imap://user%40example.com@mail.example.com/INBOX", "Seen", "ÄÖü"])
def test_java_string_hash(spark, s):
    assert one(spark, java_string_hash(F.lit(s))) == jhash(s)


def test_flag_names_order_and_user_bit(spark):
    bits = doc.FLAG_SEEN | doc.FLAG_DELETED | doc.FLAG_RECENT
    assert one(spark, doc.flag_names(F.lit(bits))) == ["Deleted", "Recent", "Seen"]
    users = F.array(F.lit("Work"))
    assert one(spark, doc.flag_names(F.lit(bits), users)) == ["Deleted", "Recent", "Seen"]
    assert one(spark, doc.flag_names(F.lit(bits | doc.FLAG_USER), users)) == ["Deleted", "Recent", "Seen", "Work"]


def test_flag_hash(spark):
    assert one(spark, doc.flag_hash(F.lit(doc.FLAG_RECENT))) == 16
    got = one(spark, doc.flag_hash(F.lit(doc.FLAG_SEEN | doc.FLAG_USER), F.array(F.lit("Work"), F.lit("ToDo"))))
    total = (doc.FLAG_SEEN | doc.FLAG_USER) + jhash("work") + jhash("todo")
    total &= 0xFFFFFFFF
    assert got == (total - (1 << 32) if total >= (1 << 31) else total)


def test_header_field_name():
    assert doc.header_field_name("Message-ID") == "header_message_id"
    assert doc.header_field_name("X Spam Score") == "header_x spam score"


def test_distinct_and_selected_headers(spark):
    h = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(v).alias("value")) for n, v in
                  [("Received", "a"), ("received", "b"), ("Received", "c"), ("Subject", "s")]])
    d = one(spark, doc.distinct_headers(h))
    assert [(r.name, r.value) for r in d] == [("Received", "a"), ("received", "b"), ("Subject", "s")]
    assert one(spark, doc.selected_header(h, "RECEIVED")) == "a"
    assert one(spark, doc.selected_header(h, "X-None")) is None


def test_doc_ids(spark):
    assert one(spark, doc_id(F.lit(7), F.lit(None).cast("string"), F.lit("imap://x/INBOX"))) == "7::imap://x/INBOX"
    assert one(spark, doc_id(F.lit(0), F.lit("UIDL1"), F.lit("pop3://x/INBOX"))) == "UIDL1::pop3://x/INBOX"
    assert one(spark, doc_id(F.lit(5), F.lit(""), F.lit("f"))) == "5::f"
    assert one(spark, key_from_doc_id(F.lit("12::a::b"))) == "12"
    assert one(spark, uid_from_doc_id(F.lit("ab::x"))) is None
    assert one(spark, mailbox_type(F.lit("x"))) == "POP"


def test_strip_tags_keeps_line_crossing_runs(spark):
    assert one(spark, doc.strip_tags(F.lit("a<b>c<d\ne>f"))) == "ac<d\ne>f"
    assert one(spark, doc.strip_tags(F.lit(None).cast("string"))) is None


def test_export_date(spark):
    ts = F.lit("2024-01-02 03:04:05.678").cast("timestamp_ntz")
    assert one(spark, doc.export_date(ts)) == "20240102T030405.678+0000"


def test_match_and_phrase(spark):
    t = F.lit("Of the People, BY the people")
    assert one(spark, tx.match(t, "people"))
    assert one(spark, tx.match(t, "xyz PEOPLE"))
    assert not one(spark, tx.match(t, "peop"))
    assert one(spark, tx.match_phrase(t, "by the"))
    assert not one(spark, tx.match_phrase(t, "the by"))
    assert one(spark, F.size(tx.tokens(t))) == 6


def test_full_match_is_whole_name(spark):
    assert one(spark, full_match(F.lit("INBOX"), "INBOX|Sent"))
    assert not one(spark, full_match(F.lit("INBOX2"), "INBOX"))


def test_invalid_pattern_fails_at_parse():
    with pytest.raises(InvalidPattern):
        validate_pattern("a|]{)/b/c(")
    with pytest.raises(InvalidPattern):
        MailOptions.from_settings({"folderpattern": "(unclosed"})


def test_options_from_string_settings():
    o = MailOptions.from_settings({"with_attachments": "true", "interval": "3s", "headers_to_fields": ["Message-ID"]})
    assert o.with_attachments and o.interval == "3 seconds" and o.headers_to_fields == ("Message-ID",)
    assert MailOptions().with_text_content and not MailOptions().with_html_content


def test_folder_selection_is_per_account(spark):
    from mailframe.operators.folders import select_folders

    rows = [("a", "X", True), ("a", "X/Y", True), ("b", "X/Y", True)]
    f = spark.createDataFrame(rows, "account string, folder_full_name string, holds_messages boolean")
    got = {(r.account, r.folder_full_name): r.selected for r in select_folders(f, "X/Y", by=("account",)).collect()}
    assert got == {("a", "X"): False, ("a", "X/Y"): False, ("b", "X/Y"): True}


def test_poll_switches_from_options():
    from mailframe.operators.sync import PollSwitches

    sw = PollSwitches.from_options(MailOptions.from_settings({"keep_expunged_messages": "true", "with_flag_sync": False}))
    assert sw == PollSwitches(with_flag_sync=False, delete_expunged=False)
    assert PollSwitches.from_options(MailOptions()) == PollSwitches()


def test_patterns_are_judged_by_the_jvm(spark):
    from mailframe.options import InvalidPattern, validate_pattern

    validate_pattern(r"\p{L}+/.*")
    validate_pattern(r"(?<n>a)b")
    with pytest.raises(InvalidPattern):
        validate_pattern(r"(?P<n>a)b")


def test_java_string_hash_outside_the_bmp(spark):
    from mailframe.functions.keys import java_string_hash

    text = "\U0001f600"  # two UTF-16 units: 0xD83D, 0xDE00
    assert spark.range(1).select(java_string_hash(F.lit(text))).first()[0] == 0xD83D * 31 + 0xDE00
    assert spark.range(1).select(java_string_hash(F.lit(""))).first()[0] == 0
