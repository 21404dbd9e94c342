"""Fingerprints of multisets that do not depend on the order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def of_ids(id_: str) -> Column:
    """An aggregate: SHA-256 of the sorted ids joined by ``;``. Null for no rows.

    The digest is defined over one sorted text, so it is for relations
    whose ids fit one task (a row per file); :func:`scalable` is for the rest.
    """
    ids = F.array_sort(F.collect_list(F.col(id_).cast("string")))
    return F.when(F.count(id_) > 0, F.sha2(F.array_join(ids, ";"), 256))


def row_token(columns: Sequence[Column], digest_size: int = 16) -> Column:
    """The first bytes, in hex, of the SHA-256 of the values' texts put together."""
    return F.substring(F.sha2(F.concat(*(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256), 1, 2 * digest_size)


def of_rows(columns: Sequence[Column], digest_size: int = 16) -> Column:
    """An aggregate: SHA-256 of the sorted row tokens' bytes."""
    tokens = F.array_sort(F.collect_list(row_token(columns, digest_size)))
    return F.sha2(F.unhex(F.array_join(tokens, "")), 256)


def scalable(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """rows and digest of a relation of any size: sums of 28-bit pieces of each row's SHA-256, hashed.

    Sensitive to multiplicity, not to order; every sum is combined map-side.
    """
    sha = F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)), 256)
    piece = lambda i: F.conv(F.substring("_h", 1 + 7 * i, 7), 16, 10).cast("decimal(38,0)")
    sums = df.select(sha.alias("_h")).agg(F.count("*").alias("rows"), *(F.sum(piece(i)).alias(f"s{i}") for i in range(9)))
    return sums.select("rows", F.sha2(F.concat_ws(",", "rows", *(F.col(f"s{i}").cast("string") for i in range(9))), 256).alias("digest"))


def aggregate_outputs(rows: DataFrame, id_: str = "part_id") -> DataFrame:
    """One row: the number of rows and the fingerprint of their ids, null for an empty table."""
    return rows.agg(F.count("*").alias("rows"), of_ids(id_).alias("fingerprint"))
