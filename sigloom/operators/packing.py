"""Packing items into tasks, and what is said about the tasks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.operators.order import with_ordinal

# The strategies' other names.
STRATEGIES = {
    "fixed": ("fixed-size", "fixed-size chunk", "chunk"),
    "weighted": ("weight", "weight-balanced", "lpt", "greedy"),
    "hash": ("mod", "modulo", "stable"),
}
SLACK = 1e-9


def strategy(name: str) -> str:
    """The strategy that a name, in any case and with blanks around, stands for."""
    wanted = name.strip().lower()
    for known, others in STRATEGIES.items():
        if wanted == known or wanted in others:
            return known
    raise ValueError(f"no such strategy: {name}")


def assigned(items: DataFrame, how: str, job: str, order: Sequence[str], weight: str, max_items: int, max_weight: float) -> DataFrame:
    """``items`` with task_idx within their job by a named strategy; ``hash`` deals by id over so many tasks as the job's number of items needs."""
    if max_items < 1:
        raise ValueError("a task needs room for an item")
    kind = strategy(how)
    if kind == "weighted":
        return weighted(items, job, order, weight, max_items, max_weight)
    counts = items.groupBy(job).agg(F.count("*").alias("_n"))
    if kind == "hash":
        tasks = F.ceil(F.col("_n") / max_items)
        return items.join(counts, job).withColumn("task_idx", F.pmod(hashed(*(F.col(c) for c in order)), tasks)).select(job, "task_idx", weight, *order)
    before = Window.orderBy(job).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(job, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = with_ordinal(items, [job, *order]).join(starts, job)
    return numbered.withColumn("task_idx", F.floor((F.col("ordinal") - F.col("_start")) / max_items)).select(job, "task_idx", weight, *order)


def hashed(*parts: Column) -> Column:
    """32 bits of the MD5 of the parts' texts, which engines agree on."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("long")


def shuffled(packed: DataFrame, keys: Sequence[str], id_: str, seed: int = 0) -> DataFrame:
    """``packed`` with place, a row's place in its task after a shuffle that seed, task and id determine; tasks are bounded."""
    by = hashed(F.lit(seed), *(F.col(k) for k in keys), F.col(id_))
    return packed.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(by, id_)) - 1)


def thousandths(x: Column) -> Column:
    """A weight as text that engines agree on."""
    return F.round(x * 1000).cast("long").cast("string")


def normalised_items(rows: DataFrame, ref: Sequence[Column], weight: Column, order: Sequence[Column | str], keep: Sequence[str] = ()) -> DataFrame:
    """payload_ref (the first of ``ref`` that is not null), weight (1 for null), idx, checksum. A negative weight fails the query."""
    value = F.coalesce(weight, F.lit(1.0))
    checked = F.when(value < 0, F.raise_error(F.lit("weight must not be negative")).cast("double")).otherwise(value)
    out = with_ordinal(rows.select(F.coalesce(*(r.cast("string") for r in ref)).alias("payload_ref"), checked.alias("weight"), *keep), order, "idx")
    return out.withColumn("checksum", checksum(F.col("payload_ref"), thousandths(F.col("weight")), F.col("idx")))


def checksum(*parts: Column) -> Column:
    """128 bits in hex over the parts, which are kept apart."""
    return F.substring(F.sha2(F.concat_ws("|", *(p.cast("string") for p in parts)), 256), 1, 32)


def fixed(items: DataFrame, order: Sequence[Column | str], size: int) -> DataFrame:
    """``items`` with task_idx: so many to a task, the last may have fewer."""
    if size < 1:
        raise ValueError("a task needs room for an item")
    return with_ordinal(items, order).withColumn("task_idx", F.floor(F.col("ordinal") / size))


def weighted(items: DataFrame, job: str, order: Sequence[str], weight: str, max_items: int, max_weight: float, keep: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """``items`` with task_idx within their job, by next fit.

    A task closes once it has ``max_items`` items or ``max_weight``, looked at after an
    item is added, so its weight may exceed the limit. ``strict`` fails on an item
    heavier than the limit. A job is packed in sequence, as the
    running sum starts anew at places that depend on all before; its sorted items stream
    through one task, which holds three numbers of it. Jobs are packed in parallel.
    """
    if max_items < 1:
        raise ValueError("a task needs room for an item")
    if strict:
        too = F.col(weight) > max_weight
        items = items.withColumn(weight, F.when(too, F.raise_error(F.lit("an item exceeds the limit")).cast("double")).otherwise(F.col(weight)))
    columns = list(dict.fromkeys([job, *order, weight, *keep]))

    def run(batches: Iterable[pd.DataFrame]):
        held, task, count, total = object(), 0, 0, 0.0
        for pdf in batches:
            found = []
            for name, w in zip(pdf[job], pdf[weight], strict=True):
                if name != held:
                    held, task, count, total = name, 0, 0, 0.0
                elif count >= max_items or total >= max_weight - SLACK:
                    task, count, total = task + 1, 0, 0.0
                count, total = count + 1, total + w
                found.append(task)
            yield pdf.assign(task_idx=pd.Series(found, index=pdf.index, dtype="int32"))

    rows = items.where(F.col(job).isNotNull()).select(*columns)
    dealt = rows.repartition(job).sortWithinPartitions(job, *order)
    return dealt.mapInPandas(run, rows.schema.add("task_idx", "integer")).select(job, "task_idx", weight, *(c for c in columns if c not in (job, weight)))


def tasks(packed: DataFrame, keys: Sequence[str], ref: str, idx: str, weight: str, seed: int = 0) -> DataFrame:
    """A row per task: its items in order, their number and weight, a checksum of all that and an id that repeats for the same content."""
    items = F.array_sort(F.collect_list(F.struct(F.col(idx).alias("idx"), F.concat_ws(":", F.col(ref).cast("string"), thousandths(F.col(weight)), F.col(idx).cast("string")).alias("ref"))))
    out = packed.groupBy(*keys).agg(items.alias("items"), F.count("*").alias("n_items"), F.sum(weight).alias("weight"))
    refs = F.array_join(F.transform("items", lambda i: i["ref"]), ";")
    out = out.withColumn("checksum", checksum(refs, F.lit(seed)))
    return out.withColumn("task_id", checksum(*(F.col(k) for k in keys), F.lit("stream"), F.lit(seed), F.col("checksum")))


def totals(built: DataFrame) -> DataFrame:
    return built.agg(F.count("*").alias("tasks"), F.sum("n_items").alias("items"), F.sum("weight").alias("weight"))


def rollup(packed: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Counts and weights of every task and, with null keys, of all."""
    return packed.rollup(*keys).agg(F.count("*").alias("row_count"), F.sum(weight).alias("weight"))
