"""Joins of items and references, and assignments round robin and by preference."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def items_left(refs: DataFrame, items: DataFrame, on: str) -> DataFrame:
    """Every reference with its item's columns, null where there is none. The optimiser picks the side to ship by its size."""
    return refs.join(items, on, "left")


def items_inner(refs: DataFrame, items: DataFrame, on: str, must_match: bool = False) -> DataFrame:
    """References with items; ``must_match`` fails the query on one without."""
    if not must_match:
        return refs.join(items, on)
    marked = refs.join(items.withColumn("_found", F.lit(True)), on, "left")
    missing = F.raise_error(F.concat(F.lit("no item for "), F.col(on).cast("string"))).cast("boolean")
    return marked.where(F.coalesce(F.col("_found"), missing)).drop("_found")


def round_robin(workers: DataFrame, worker: str, devices: int) -> DataFrame:
    """A device number for every worker, by remainder; null without devices."""
    return workers.withColumn("device", F.pmod(F.col(worker), F.lit(devices)).cast("int") if devices else F.lit(None).cast("int"))


def preferred(devices: DataFrame, device: str, wanted: list) -> DataFrame:
    """Devices of the list in its order; all of them, by number, where none matches."""
    spark = devices.sparkSession
    kind = devices.schema[device].dataType.simpleString()
    order = spark.createDataFrame([(w, i) for i, w in enumerate(wanted)], f"{device} {kind}, place int")
    found = devices.join(F.broadcast(order), device, "left")
    some = found.agg(F.max("place").alias("_any"))  # one row
    out = found.join(F.broadcast(some)).where(F.col("place").isNotNull() | F.col("_any").isNull())
    rank = F.row_number().over(Window.orderBy(F.coalesce("place", F.lit(0)), device)) - 1  # of a machine's few devices
    return out.withColumn("rank", rank).drop("place", "_any")


def map_merged(left, right):
    """Two maps as one; the right one's values win. No setting of the session is needed."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)
