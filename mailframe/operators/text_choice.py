"""Text choice of a multipart/alternative message (P9, P10) over a flat parts table.

Input: one row per part - ``message_id``, ``pos`` (order in the message), ``mime``
(lower-case type/subtype) and ``text``.  The rules, in message order:

* without preferHtml: the first text/plain part with text wins; a part that is
  neither plain nor html ends the choice with its own text (even null); at the
  end the first html part with text is taken.
* with preferHtml: the first html part ends the choice with its text (even
  null); plain parts are skipped; another part type ends it with its own text.

Computed by a partially aggregating ``groupBy`` of the smallest (pos, text) pair
per part class, so a message with many parts is never gathered in one place.
Nested trees are decided inside the parse stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLAIN = "text/plain"
HTML = "text/html"


def choose_text(parts: DataFrame, prefer_html: bool = False, out_col: str = "text_content") -> DataFrame:
    mime = F.col("mime")
    pt = F.struct(F.col("pos").alias("pos"), F.col("text").alias("text"))
    is_other = ~mime.isin(PLAIN, HTML)
    agg = parts.groupBy("message_id").agg(
        F.min(F.when((mime == PLAIN) & F.col("text").isNotNull(), pt)).alias("_plain"),
        F.min(F.when(mime == HTML, pt)).alias("_html1"),
        F.min(F.when((mime == HTML) & F.col("text").isNotNull(), pt)).alias("_html"),
        F.min(F.when(is_other, pt)).alias("_other"),
    )
    other_pos = F.col("_other.pos")
    before_other = lambda c: F.col(c).isNotNull() & (other_pos.isNull() | (F.col(c + ".pos") < other_pos))
    if prefer_html:
        chosen = (
            F.when(before_other("_html1"), F.col("_html1.text"))
            .when(F.col("_other").isNotNull(), F.col("_other.text"))
        )
    else:
        chosen = (
            F.when(before_other("_plain"), F.col("_plain.text"))
            .when(F.col("_other").isNotNull(), F.col("_other.text"))
            .otherwise(F.col("_html.text"))
        )
    return agg.select("message_id", chosen.alias(out_col))
