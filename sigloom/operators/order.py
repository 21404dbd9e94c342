"""Ordinals, heads, samples and first-of-group without gathering a table or a group in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.tables import written

def with_ordinal(df: DataFrame, order: Sequence[Column | str], name: str = "ordinal") -> DataFrame:
    """Numbers rows from 0 in ``order``, which must be total.

    Rows are dealt by range and sorted within partitions; a row's number is
    its partition's offset plus its place there. The dealt rows are written first: dealing
    samples anew each time, and both steps must see one dealing. Only one count a partition is broadcast.
    """
    keys = {f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    columns = df.columns
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumns(keys).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # the id's high bits name the partition, the low 33 count its rows
    dealt = written(dealt.select(*columns, F.monotonically_increasing_id().alias("_id")), "ordinal")
    part = F.shiftright("_id", 33)
    counts = dealt.groupBy(part.alias("_part")).count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    out = dealt.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return out.select(*columns, (F.col("_offset") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def head(df: DataFrame, order: Sequence[Column | str], n: int | None = None, frac: float | None = None) -> DataFrame:
    """The first ``n`` rows, or the first ``ceil(frac * rows)``; ``n`` wins. From the head, not at random."""
    if n is None and frac is None:
        return df
    if n is None:
        # a share of a large table is large: it is numbered and cut where it lies, in no single place
        wanted = math.ceil(min(1.0, max(0.0, frac)) * df.count())
        return with_ordinal(df, order, "_ordinal").where(F.col("_ordinal") < wanted).drop("_ordinal")
    return df.orderBy(*order).limit(max(0, n))


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key with their rank from 1.

    Spark cuts each task's rows of a key down to ``k`` before they are dealt (WindowGroupLimit), so a
    key with very many rows comes to its task as k rows from each.
    """
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def sample_k(df: DataFrame, keys: Sequence[str], by: Column, k: int) -> DataFrame:
    """At most ``k`` rows of each key, those with the smallest ``by`` (a hash of the row's id)."""
    return first_k(df.withColumn("_by", by), keys, ["_by"], k).drop("_by", "rank")


def hash_sample(df: DataFrame, id_: Column, rate: float) -> DataFrame:
    """Rows whose id's MD5 falls below ``rate``, in thousandths: the same ones every time, whatever pattern ids follow."""
    prefix = F.conv(F.substring(F.md5(id_.cast("string")), 1, 8), 16, 10).cast("long")
    return df.where(F.pmod(prefix, F.lit(1000)) < round(rate * 1000))


def every_nth(df: DataFrame, order: Sequence[Column | str], n: int = 100) -> DataFrame:
    """Each ``n``-th row in ``order``, with its ordinal from 1: what a job reports of its progress."""
    return with_ordinal(df, order).withColumn("ordinal", F.col("ordinal") + 1).where(F.col("ordinal") % n == 0)


def cyclic(df: DataFrame, order: Sequence[Column | str], target: int, id_: str) -> DataFrame:
    """Repeats rows round and round up to ``target`` of them; copies are named ``<id>_dup<k>`` and tell their origin."""
    total = df.count()
    if not total:
        return df.withColumn("duplicate_of", F.lit(None).cast("string")).withColumn("copy", F.lit(0))
    rounds = -(-max(target, total) // total)
    out = with_ordinal(df, order).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    out = out.where(F.col("copy") * total + F.col("ordinal") < max(target, total))
    copied = F.col("copy") > 0
    name = F.col(id_).cast("string")
    return out.withColumn("duplicate_of", F.when(copied, name)).withColumn(id_, F.when(copied, F.concat(name, F.lit("_dup"), F.col("copy"))).otherwise(name)).drop("ordinal")
