"""Limiting and sampling log events."""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.tables import written


class Burst:
    """Admits ``burst`` events in any ``interval`` seconds; only admitted ones count."""

    def __init__(self, burst: int, interval: float, admitted: Iterable[float] = ()):
        self.burst, self.interval, self.admitted = burst, interval, deque(admitted)

    def admit(self, ts: float) -> bool:
        while self.admitted and self.admitted[0] <= ts - self.interval:
            self.admitted.popleft()
        if len(self.admitted) >= self.burst:
            return False
        self.admitted.append(ts)
        return True


def burst_limit(events: DataFrame, keys: Sequence[str], ts: str, id_: str, burst: int, interval: float) -> DataFrame:
    """``keys``, ``id_`` and admitted for every event, taken in the order of ts and id.

    A gap of ``interval`` or more empties the window, so a key's events fall into
    independent runs, which are dealt apart. Gaps are found over ranges of the sorted events, each of which knows the
    last event before it, so that no key meets in one task. A worker streams through its runs and holds ``burst`` times at most.
    """
    seconds = F.col(ts).cast("timestamp").cast("double") if dict(events.dtypes)[ts].startswith("timestamp") else F.col(ts).cast("double")
    rows = events.select(*keys, id_, seconds.alias("_ts"))
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, "_ts", id_]
    # written, as dealing by range samples anew each time; the id's high bits name the range
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = written(rows, "events").withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.struct(*keys, "_ts"))
    ends = rows.groupBy("_part").agg(F.max_by("_at", "_id").alias("_end"))
    ends = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_end"))
    inside = Window.partitionBy("_part").orderBy("_id")
    before = F.coalesce(F.lag("_at").over(inside), F.col("_end"))
    same = [before[k].eqNullSafe(F.col(k)) for k in keys]
    rows = rows.join(F.broadcast(ends), "_part")
    rows = rows.withColumn("_fresh", ~F.coalesce(functools.reduce(lambda a, b: a & b, same) & (F.col("_ts") - before["_ts"] < interval), F.lit(False)))
    # a run that goes on from the range before has the number that it had there
    rows = rows.withColumn("_no", F.sum(F.col("_fresh").cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    starts = rows.groupBy("_part").agg(F.sum(F.col("_fresh").cast("long")).alias("_many"))
    starts = starts.select("_part", F.coalesce(F.sum("_many").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    rows = rows.join(F.broadcast(starts), "_part").withColumn("_run", F.col("_start") + F.col("_no"))
    names = [*keys, id_]

    def run(batches: Iterable[pd.DataFrame]):
        held, window = None, None
        for pdf in batches:
            admitted = []
            for run_, ts_ in zip(zip(*(pdf[k] for k in keys), pdf["_run"], strict=True), pdf["_ts"], strict=True):
                if run_ != held:
                    held, window = run_, Burst(burst, interval)
                admitted.append(window.admit(ts_))
            yield pdf[names].assign(admitted=admitted)

    schema = events.select(*names).schema.add("admitted", "boolean")
    dealt = rows.repartition(*keys, "_run").sortWithinPartitions(*keys, "_run", "_ts", id_)
    return dealt.mapInPandas(run, schema)
