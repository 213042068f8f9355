"""Positional message numbers (1..n per folder) computed without a per-folder task.

A POP / IMAP message number is the rank of a message inside its folder by UID.
A plain ``row_number()`` window would sort a whole folder in one task, and one
folder may hold a third of all rows.  Here UIDs are cut into fixed-width buckets:
each (folder, bucket) holds at most ``bucket_width`` rows and is numbered by a
window; the row counts of the earlier buckets of the same folder (a small,
partially aggregated table) are added on top.  Everything is a function of the
data alone, so a recomputed stage gives the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 16


def number_within_group(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    out_col: str = "msg_num",
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
) -> DataFrame:
    """Add ``out_col`` = 1-based position of each row in its group by integral ``order_col``.

    ``order_col`` must be unique inside a group (a UID is).
    """
    bucketed = df.withColumn("_bucket", F.floor(F.col(order_col) / F.lit(bucket_width)))
    counts = bucketed.groupBy(*group_cols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*group_cols, "_bucket").orderBy(order_col)
    return (
        bucketed.withColumn("_pos", F.row_number().over(inside))
        .join(offsets, [*group_cols, "_bucket"])
        .withColumn(out_col, (F.col("_pos") + F.col("_before")).cast("int"))
        .drop("_bucket", "_pos", "_before")
    )
