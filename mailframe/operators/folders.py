"""Folder enumeration and selection.

The reference walks the folder tree recursively on the server.  A folder table
with full paths is flat, so the walk becomes: every path's ancestors by
``explode(sequence(...))``, a join to the folder table, and one ``bool_or`` per
folder.  No recursion, no driver loop, and the work is spread by folder.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailframe.options import validate_pattern

SEPARATOR = "/"


def full_match(name: str | Column, pattern: str) -> Column:
    """the whole name matches ``pattern`` (not a search)."""
    validate_pattern(pattern)
    col = F.col(name) if isinstance(name, str) else name
    return col.rlike(r"\A(?:" + pattern + r")\z")


def folder_tree(paths: DataFrame, path_col: str = "folder_full_name", sep: str = SEPARATOR) -> DataFrame:
    """Every folder named by a path and by all its ancestors, once, with its depth."""
    parts = F.split(F.col(path_col), re.escape(sep))
    return (
        paths.select(parts.alias("_p"))
        .select("_p", F.explode(F.sequence(F.lit(1), F.size("_p"))).alias("depth"))
        .select(F.array_join(F.slice("_p", 1, F.col("depth")), sep).alias("folder_full_name"), "depth")
        .distinct()
    )


def select_folders(folders: DataFrame, pattern: str | None, start: str | None = None,
                   sep: str = SEPARATOR, by: tuple[str, ...] = ()) -> DataFrame:
    """Which message-holding folders a poll opens.

    ``folders``: ``folder_full_name``, ``holds_messages``.  A holding folder that does
    not match hides its whole subtree; a folder holding no messages is passed
    through (its children are still visited).  ``start`` limits the walk to one
    subtree; a start folder that does not match selects nothing.
    Output: every input folder with ``matches``, ``pruned`` and ``selected``.
    ``by`` names columns that separate folder trees (e.g. ``account``).
    """
    by = list(by)
    name = F.col("folder_full_name")
    matches = full_match(name, pattern) if pattern is not None else F.lit(True)
    f = folders.withColumn("matches", matches).withColumn(
        "depth", F.size(F.split(name, re.escape(sep)))
    )
    blockers = f.filter(F.col("holds_messages") & ~F.col("matches")).select(
        *by, F.col("folder_full_name").alias("_anc")
    )
    # proper ancestors only; sequence(1, 0) would count down, so depth 1 gets none
    above = F.when(F.col("depth") > 1, F.sequence(F.lit(1), F.col("depth") - 1)).otherwise(F.array().cast("array<int>"))
    ancestors = f.select(*by, "folder_full_name", F.explode(above).alias("_d")).select(
        *by,
        "folder_full_name",
        F.array_join(F.slice(F.split(name, re.escape(sep)), 1, F.col("_d")), sep).alias("_anc"),
    )
    pruned = ancestors.join(blockers, [*by, "_anc"], "left_semi").select(*by, "folder_full_name").distinct() \
        .withColumn("pruned", F.lit(True))
    out = f.join(pruned, [*by, "folder_full_name"], "left").withColumn("pruned", F.coalesce("pruned", F.lit(False)))
    selected = F.col("holds_messages") & F.col("matches") & ~F.col("pruned")
    if start is not None:
        in_tree = (name == F.lit(start)) | name.startswith(start + sep)
        start_ok = F.lit(True) if pattern is None else full_match(F.lit(start), pattern)
        selected = selected & in_tree & start_ok
    return out.withColumn("selected", selected).drop("depth")
