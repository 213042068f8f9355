"""Sources: settings files, directory exports, .eml trees, full document JSON export."""

import json
import os
from email.mime.application import MIMEApplication
from email.mime.multipart import MIMEMultipart
from email.mime.text import MIMEText

from pyspark.sql import functions as F

from mailframe.operators.documents import export_json, to_documents
from mailframe.operators.parse import parse_messages
from mailframe.options import MailOptions
from mailframe.sources import accounts as acc
from mailframe.sources.raw import read_eml_tree


def test_accounts_from_settings_file(spark, scratch):
    p = os.path.join(scratch, "settings.json")
    with open(p, "w") as f:
        json.dump({"user": "main@x", "users": ["a@x", None, "b@x"], "mail_index_name_strategy": "username_crop"}, f)
    s = acc.read_settings(spark, p)
    got = [(r.pos, r.account) for r in acc.accounts_from_settings(s).orderBy("pos").collect()]
    assert got == [(0, "main@x"), (1, "a@x"), (2, "b@x")]
    idx = s.select(acc.index_name(F.col("mail_index_name_strategy"), F.col("user")).alias("i")).first().i
    assert idx == "main"


def test_accounts_from_directory_export(spark):
    e = spark.createDataFrame([("uid=alice,ou=p,dc=x", "Alice"), ("uid=bob,ou=p,dc=x", None), ("cn=carol", "C"),
                               ("uid=d=e,ou=p", "D"), ("noequals", "N")], "dn string, name string")
    got = sorted(r.login for r in acc.accounts_from_directory(e, master="adm").collect())
    assert got == ["alice*adm", "carol*adm", "d*adm"]
    assert sorted(r.login for r in acc.accounts_from_directory(e).collect()) == ["alice", "carol", "d"]




def test_eml_tree_parse_and_export(spark, scratch):
    inbox = os.path.join(scratch, "mail", "INBOX")
    os.makedirs(inbox)
    m = MIMEMultipart("mixed")
    m["Subject"] = "with attachment"
    m["Date"] = "Tue, 02 Jan 2024 10:00:00 +0000"
    m.attach(MIMEText("<b>Text</b>", "plain"))
    a = MIMEApplication(b"%PDF-1.4\n" * 20, "pdf")
    a.add_header("Content-Disposition", "attachment", filename="a.pdf")
    m.attach(a)
    with open(os.path.join(inbox, "1.eml"), "wb") as f:
        f.write(m.as_bytes())
    with open(os.path.join(inbox, "2.eml"), "wb") as f:
        f.write(b"Subject: plain\r\n\r\nhello\r\n")
    raw = read_eml_tree(spark, os.path.join(scratch, "mail")).withColumn(
        "uid", F.regexp_extract("path", r"/(\d+)\.eml$", 1).cast("bigint"))
    parsed = parse_messages(raw, keep=["folder_uri", "uid"], with_attachments=True)
    docs = to_documents(parsed, MailOptions(with_attachments=True, headers_to_fields=("Subject",)))
    rows = {r.uid: r for r in docs.collect()}
    assert rows[1].subject == "with attachment" and rows[1].textContent == "Text"
    assert rows[1].attachmentCount == 1 and rows[1].attachments[0].filename == "a.pdf"
    assert rows[2].attachmentCount == 0 and rows[2].header_subject == "plain"
    js = {r.doc_id.split("::")[0]: json.loads(r.json) for r in export_json(docs).collect()}
    assert js["1"]["sentDate"] == "20240102T100000.000+0000"
    assert js["1"]["attachments"][0]["content"].startswith("JVBERi0xLjQK") and "\n" not in js["1"]["attachments"][0]["content"]
    assert js["2"]["attachments"] is None and js["2"]["header_subject"] == "plain"


def test_content_switches_change_the_projection(spark):
    from email.mime.multipart import MIMEMultipart as MM

    m = MM("alternative")
    m.attach(MIMEText("plain <i>p</i>", "plain"))
    m.attach(MIMEText("<b>html</b>", "html"))
    raw = spark.createDataFrame([("imap://a/INBOX", 1, m.as_bytes())], "folder_uri string, uid bigint, raw binary")

    def doc_with(**kw):
        o = MailOptions(**kw)
        p = parse_messages(raw, keep=["folder_uri", "uid"], with_text=o.with_text_content,
                           with_html=o.with_html_content, prefer_html=o.prefer_html_content)
        return to_documents(p, o).first()

    d = doc_with()
    assert d.textContent == "plain p" and d.htmlContent is None  # defaults: text on, tags stripped, html off
    assert doc_with(with_striptags_from_textcontent=False).textContent == "plain <i>p</i>"
    assert doc_with(with_text_content=False).textContent is None
    assert doc_with(with_html_content=True).htmlContent == "<b>html</b>"
    assert doc_with(prefer_html_content=True).textContent == "html"
