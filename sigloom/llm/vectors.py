"""Columns of vectors, as operators 4 and 9 take them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.grouping import lists


def usable(rows: DataFrame, vector: str, zero: bool = True) -> Column:
    """Whether a row's vec_id and vector are not null and its components are finite numbers.

    Vectors of another length than most rows have (the longer one, if as many) do
    not count; with ``zero`` false those of zeros alone neither.
    """
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = v.isNotNull() & F.col("vec_id").isNotNull() & (F.size(v) > 0) & finite
    if not zero:
        good &= F.exists(v, lambda x: x != 0)
    common = rows.where(good).groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return F.coalesce(good & (F.size(v) == (common["n"] if common else -1)), F.lit(False))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    values, at = lists(column)
    return values.astype(np.float64).reshape(len(at) - 1, -1)
