"""Store queries (F5-F9, A1-A3, L1, S7, S8): the reference's search-API calls as DataFrame ops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def term(col: str, value) -> Column:
    """exact match on a not-analysed field (pushed to the Parquet scan)."""
    return F.col(col) == F.lit(value)


def terms(col: str, values: list) -> Column:
    """F6 for a literal list: value in set."""
    return F.col(col).isin(list(values))


def bool_must(df: DataFrame, *preds: Column, table_terms: list[tuple[DataFrame, list[str]]] = ()) -> DataFrame:
    """AND of predicates; ``table_terms`` are F6 sets given as tables (semi joins)."""
    out = df.filter(reduce(lambda a, b: a & b, preds)) if preds else df
    for keys_df, keys in table_terms:
        out = out.join(keys_df.select(*keys), keys, "left_semi")
    return out


def restrict(df: DataFrame, index_name: str | None = None, type_name: str | None = None) -> DataFrame:
    """index / type restriction; on the store's log both are partitions, so other tables' files are not opened."""
    if index_name is not None:
        df = df.filter(F.col("index_name") == index_name)
    if type_name is not None:
        df = df.filter(F.col("type_name") == type_name)
    return df


def first_hits(df: DataFrame, order_col: str, n: int = 1) -> DataFrame:
    """L1: the first ``n`` hits, fixed by an order column (top-n: a partial sort per task)."""
    return df.orderBy(order_col).limit(n)


def lookup(keys: DataFrame, store: DataFrame, on: list[str], field: str, alias: str) -> DataFrame:
    """S8 bulk point lookup: one join instead of one request per message; null = missing."""
    return keys.join(store.select(*on, F.col(field).alias(alias)), on, "left")


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """A1: count per group (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, pred: Column, name: str = "n") -> DataFrame:
    """A2: one count over a filtered set."""
    return df.filter(pred).agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """A3 / S7."""
    return df.select(*cols).distinct()


def nested(array_col: str, *conditions) -> Column:
    """some one element of an array of structs (``headers``, ``to``, ``cc``, ``bcc``, ``attachments``) meets all conditions.

    A condition is a function of the element, e.g. ``lambda a: a["email"] == "x@y"``.  All are
    tested on the same element, which a conjunction of flat filters does not do; a
    null array and a null element meet nothing.
    """
    def meets(element: Column) -> Column:
        return F.coalesce(reduce(lambda a, b: a & b, [c(element) for c in conditions], element.isNotNull()), F.lit(False))

    return F.coalesce(F.exists(F.col(array_col), meets), F.lit(False))
