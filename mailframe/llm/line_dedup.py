"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

A line's key is the line without white space at its ends and with A-Z lower-cased.  Of the
documents that hold a key of ``MIN_CHARS`` code points or more, the one with the smallest id
keeps its lines; all others lose theirs.

The index is a set of runs.  A run holds every key hash once, with the smallest document that
holds it, bucketed by the hash and sorted by it within a bucket.  Documents come in batches of
ascending ids.  A batch is first aggregated to one row a key, then merge-joined with the runs,
which need no shuffle as they lie in the buckets that the join wants; keys without a partner
(the anti side) are new and become a run of the lowest level, with the others the batch's
lines are found that an earlier document holds.  When a level has ``FANOUT`` runs they are
compacted to one run of the next level, so the number of runs to merge with grows with the
logarithm of the batches, and every hash is rewritten once a level.

A line that a large share of all documents hold is one row of the aggregated batch; only the
join that brings verdicts back to lines meets all its rows.  There, keys with more than
1/``HOT_SHARE`` of a batch's lines (so at most ``HOT_SHARE`` keys) are broadcast, and the rest
is a plain equi-join, which adaptive execution may split further.

A hash is 128 bits of two differently seeded xxhash64; two keys of equal hash would count as one.

Defined results: null and empty texts are one empty line; a null id comes after all others
and all null ids are one id; rows of equal id keep and lose the same keys; repeated lines in the
keeping document all stay; texts and lines may have any length; an empty table gives no rows; other
columns, whatever their names, pass through ``drop_repeated_lines`` unchanged, but for those of its results.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailframe.llm.common import scratch_table, shuffle_partitions
from mailframe.session import checkpoint_path

#: Shortest key that makes a line a candidate.
MIN_CHARS = 10
#: Batches into which one table is dealt by ascending ids.
BATCHES = 4
#: Runs of a level that are compacted to one of the next.
FANOUT = 3
#: A key with more than one in so many of a batch's lines is hot; there are fewer of those than this.
HOT_SHARE = 1000
#: Stripped at both ends of a line.
WHITE = " \t\n\x0b\x0c\r"

HASH = ["k1", "k2"]


@dataclass
class LineIndex:
    """Levelled runs: ``levels[i]`` lists the catalog names of level i's runs."""

    spark: SparkSession
    levels: list[list[str]] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _write(self, rows: DataFrame) -> str:
        """Bucketed by the hash, sorted within a bucket, one file each."""
        name = f"line_run_{uuid.uuid4().hex}"
        n = shuffle_partitions(self.spark)
        path = checkpoint_path(self.spark, name)
        rows.repartition(n, *HASH).write.bucketBy(n, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        return name

    def add(self, rows: DataFrame) -> None:
        """A new run of (k1, k2, holder); compacts every level that is full."""
        name, level = self._write(rows), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(name)
            if len(self.levels[level]) < FANOUT:
                return
            full, self.levels[level] = self.levels[level], []
            # read as plain files: a union of bucketed tables counts as dealt by the hash, though it is not, and would not be dealt anew
            files = [checkpoint_path(self.spark, other) for other in full]
            merged = self.spark.read.schema(self.spark.table(full[0]).schema).parquet(*files)
            name, level = self._write(merged), level + 1
            self._drop(full)

    def holders(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``holder``: the document of an earlier batch that holds the key, or null."""
        for run in self.runs():
            found = run.select(*HASH, F.col("holder").alias("found"))
            keys = keys.join(found.hint("merge"), HASH, "left").withColumn("holder", F.coalesce("holder", "found")).drop("found")
        return keys

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def close(self) -> None:
        """Forget the runs; their files stay in the shared folder like any intermediate table."""
        for level in self.levels:
            self._drop(level)
        self.levels = []


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _rank(doc_id: Column) -> Column:
    """Documents in the order in which they keep lines: struct<none, id>; a null id is last."""
    return F.named_struct(F.lit("none"), doc_id.isNull(), F.lit("id"), F.coalesce(doc_id, F.lit(0)))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_hash, pos, k1, k2) of every line whose key is long enough; the text's hash tells rows of one id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)  # as many characters, and no line break comes or goes
    each = docs.select(_rank(F.col(id_col).cast("bigint")).alias("doc"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(lower, "\n")).alias("pos", "line"))
    keys = each.select("doc", "text_hash", "pos", F.btrim("line", F.lit(WHITE)).alias("line_key")).filter(F.length("line_key") >= MIN_CHARS)
    return keys.select("doc", "text_hash", "pos", F.xxhash64("line_key").alias("k1"), F.xxhash64(F.lit(1), "line_key").alias("k2"))


def add_batch(index: LineIndex, lines: DataFrame) -> DataFrame:
    """Lines of a batch that an earlier document holds: (doc, text_hash, pos); the index then holds the batch's keys too.

    ``lines`` as of ``line_hashes``; no document of the batch may come before one of an earlier batch.
    """
    keys = lines.groupBy(*HASH).agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n"))
    keys = scratch_table(index.holders(keys.withColumn("holder", F.lit(None).cast("struct<none:boolean,id:bigint>"))), "line-keys")
    index.add(keys.filter("holder IS NULL").select(*HASH, F.col("least").alias("holder")))
    repeated = keys.filter("holder IS NOT NULL OR least < most").select(*HASH, F.coalesce("holder", "least").alias("keeper"), "n")
    total = lines.count()
    hot = F.broadcast(repeated.filter(F.col("n") * HOT_SHARE > total).drop("n"))
    cold = lines.join(F.broadcast(hot.select(*HASH)), HASH, "left_anti").join(repeated.filter(F.col("n") * HOT_SHARE <= total).drop("n"), HASH)
    return lines.join(hot, HASH).unionByName(cold).filter("keeper < doc").select("doc", "text_hash", "pos")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with (n_lines, n_dropped, kept): the lines that stay, joined by line breaks."""
    spark = docs.sparkSession
    bounds = docs.select(F.percentile_approx(F.col(id_col).cast("bigint"), [i / BATCHES for i in range(1, BATCHES)]).alias("b")).first()["b"] or []
    batch = sum((F.coalesce((F.col("doc.id") > b) | F.col("doc.none"), F.lit(False)).cast("int") for b in bounds), F.lit(0))
    lines = scratch_table(line_hashes(docs, id_col, text_col).withColumn("batch", batch), "line-hashes", partition="batch")
    index, gone = LineIndex(spark), []
    for b in range(len(bounds) + 1):
        gone.append(scratch_table(add_batch(index, lines.filter(F.col("batch") == b).drop("batch")), "lines-gone"))
    index.close()
    dropped = gone[0]
    for part in gone[1:]:
        dropped = dropped.unionByName(part)
    lost = dropped.groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("lost"))
    rows = docs.select(F.struct(*docs.columns).alias("row"))  # so that no name can clash
    text_of, id_of = F.col("row")[text_col], F.col("row")[id_col].cast("bigint")
    same = (_rank(id_of) == F.col("doc")) & (F.xxhash64(F.coalesce(text_of, F.lit(""))) == F.col("text_hash"))
    joined = rows.join(lost, same, "left")
    away = F.coalesce(F.col("lost"), F.array().cast("array<int>"))

    def kept(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), away)
        return F.struct(F.size(lines).cast("bigint").alias("n_lines"), F.array_join(F.transform(stay, lambda p: F.get(lines, p)), "\n").alias("kept"))

    # the lines are computed once per row: a plain column would be, for each element, anew
    result = F.get(F.transform(F.array(_lines(text_of)), kept), F.lit(0))
    joined = joined.select("row", F.size(away).cast("bigint").alias("n_dropped"), result.alias("result"))
    others = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")]
    return joined.select(*others, "result.n_lines", "n_dropped", "result.kept")


_WHITE_SQL = " || ".join(f"chr({ord(c)})" for c in WHITE)
LINE_SQL = f"""
WITH src AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM src),
keyed AS (SELECT *, trim(translate(line, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), {_WHITE_SQL}) AS key FROM lines),
keepers AS (SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key),
judged AS (SELECT d.doc_id, line, pos, coalesce(keeper < d.doc_id, false) AS gone FROM keyed d LEFT JOIN keepers USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
