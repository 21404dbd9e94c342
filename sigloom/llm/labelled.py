"""Bounded samples of labelled rows, for the operators that fit a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out() -> Column:
    """Whether a row's labels are kept for testing; a row without doc_id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def thinned(rows: DataFrame, most: int, salt: int = 0) -> DataFrame:
    """About ``most`` of the rows (all, if there are fewer), chosen by a hash of all columns.

    Nothing is sorted or moved: the share is worked out from a count. Rows that repeat are chosen or left
    together, so whoever collects them sets a limit.
    """
    n = rows.count()
    if n <= most:
        return rows
    steps = 1 << 40
    return rows.where(F.pmod(F.xxhash64(*rows.columns, F.lit(salt)), F.lit(steps)) < F.lit(int(steps * most / n)))


def learning(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and label (0 or 1) of the rows to learn from; of a doc_id's labels the largest, nulls left out."""
    rows = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
    return rows.groupBy("doc_id").agg(F.max(F.col(column)).cast("int").alias("label"))
