"""Shared by the vector operators: cleaned integer vectors as a written table, and their numpy form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import scratch_table


def _usable(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def integer_vectors(rows: DataFrame, scale: int, limit: int, keep: dict[str, Column], vector: str = "embedding") -> tuple[DataFrame, list]:
    """(written table of ``id``, ``keep`` columns and ``v`` array<int>; the 16 rows of the smallest ids).

    A component x becomes floor(scale * x), held within +-``limit`` (their squares must fit a
    long).  Rows without usable vectors are left out, and so are those whose length is not
    that of the row with the smallest id.  Null ids come after all others.
    """
    value = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(limit))), F.lit(float(-limit)))).cast("int")
    good = rows.filter(_usable(F.col(vector))).select(*(c.alias(n) for n, c in keep.items()), F.transform(vector, value).alias("v"))
    good = scratch_table(good, "vectors")
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    first = good.orderBy(*order).limit(1).collect()
    if not first:
        return good, []
    good = good.filter(F.size("v") == len(first[0]["v"]))
    return good, good.orderBy(*order).limit(16).collect()


def matrix(column: pa.Array, dim: int, width: int) -> np.ndarray:
    """int64 matrix of a column of equally long lists, with zeros up to ``width`` columns."""
    out = np.zeros((len(column), width), np.int64)
    if dim:
        out[:, :dim] = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
    return out
