"""An at-least-once queue as a fold over its log of operations.

A log row is (rec_id, seq, ts, op, arg): op is put, lease, ack, nack or extend, ts a logical
clock in seconds, arg the lease time or the delay. The state of a record is
(acked, lease_until, visible_at, attempts, dead); time passes only by the clock.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPS = ("put", "lease", "ack", "nack", "extend")
STATE = "rec_id long, status string, attempts int, lease_until double, visible_at double, dead boolean"
LEAST_TTL = 0.1


@dataclasses.dataclass
class Record:
    """State of one record, changed by :meth:`apply`; batch and stream share it."""

    acked: bool = False
    known: bool = False
    dead: bool = False
    attempts: int = 0
    lease_until: float = 0.0
    visible_at: float = 0.0

    def pass_time(self, now: float, retry_delay: float) -> None:
        if self.lease_until and self.lease_until <= now:
            self.visible_at, self.lease_until = self.lease_until + retry_delay, 0.0

    def apply(self, op: str, ts: float, arg: float, max_attempts: int = 0, retry_delay: float = 0.0) -> None:
        self.pass_time(ts, retry_delay)
        if op == "put":
            self.known = True
        elif not self.known or self.acked:
            return
        elif op == "lease":
            if not self.lease_until and self.visible_at <= ts:
                if max_attempts and self.attempts >= max_attempts:
                    self.acked = self.dead = True  # given up; kept apart from what was done
                else:
                    self.attempts += 1
                    self.lease_until = ts + max(arg, LEAST_TTL)
        elif op == "ack":
            self.acked, self.lease_until = True, 0.0
        elif op == "nack":
            self.lease_until, self.visible_at = 0.0, ts + max(arg, 0.0)
        elif op == "extend" and self.lease_until:
            self.lease_until = ts + max(arg, LEAST_TTL)

    def status(self, now: float) -> str:
        if not self.known:
            return "unknown"
        if self.acked:
            return "dead" if self.dead else "acked"
        return "leased" if self.lease_until > now else "visible" if self.visible_at <= now else "delayed"


def fold(log: DataFrame, now: float, max_attempts: int = 0, retry_delay: float = 0.0) -> DataFrame:
    """The state of every record after its log, at time ``now``.

    Logs are dealt by record and sorted there; a worker holds one record's state at
    a time, not its log. Unknown ops are ignored; ties in ts go by seq.
    """

    def run(batches: Iterable[pd.DataFrame]):
        record, held, out = Record(), None, []

        def close():
            record.pass_time(now, retry_delay)
            out.append((held, record.status(now), record.attempts, record.lease_until, record.visible_at, record.dead))

        for pdf in batches:
            for rec, ts, op, arg in zip(pdf["rec_id"], pdf["ts"], pdf["op"], pdf["arg"].fillna(0.0), strict=True):
                if held is not None and rec != held:
                    close()
                    record = Record()
                held = rec
                record.apply(op, ts, arg, max_attempts, retry_delay)
            if out:
                yield pd.DataFrame(out, columns=["rec_id", "status", "attempts", "lease_until", "visible_at", "dead"])
                out = []
        if held is not None:
            close()
            yield pd.DataFrame(out, columns=["rec_id", "status", "attempts", "lease_until", "visible_at", "dead"])

    dealt = log.where(F.col("rec_id").isNotNull()).repartition("rec_id").sortWithinPartitions("rec_id", "ts", "seq")
    return dealt.select("rec_id", "ts", "op", F.col("arg").cast("double").alias("arg")).mapInPandas(run, STATE)


def visible(states: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Records of a fold that can be leased at its time: put, not acked, not leased, their delay over, attempts left."""
    out = states.where("status = 'visible'")
    return out if max_attempts is None else out.where(F.col("attempts") < max_attempts)


def lease(states: DataFrame, n: int, max_attempts: int | None = None) -> DataFrame:
    """The first ``n`` visible records by id."""
    return visible(states, max_attempts).orderBy("rec_id").limit(n)


def stats(states: DataFrame) -> DataFrame:
    """Records by status; total are those that were put, delayed ones among them."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return states.agg(*(count(s) for s in ("visible", "leased", "acked", "dead")), F.count_if(F.col("status") != "unknown").alias("total"))


def head_segment(records: DataFrame, size: int) -> DataFrame:
    """The least segment that holds a record neither done nor given up, else the last one."""
    segment = F.floor(F.col("rec_id") / size)
    return records.agg(F.coalesce(F.min(F.when(~F.col("status").isin("acked", "dead"), segment)), F.max(segment)).alias("head_segment"))


def ack_bitmap(acked: DataFrame, size: int = 32) -> DataFrame:
    """Per segment of ``size`` records a bit for each acked one."""
    rows = acked.select(F.floor(F.col("rec_id") / size).alias("segment"), F.pmod("rec_id", F.lit(size)).cast("int").alias("bit")).distinct()
    return rows.groupBy("segment").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count("*").alias("acked"))


def drained(records: DataFrame) -> DataFrame:
    return stats(records).select((F.col("total") == F.col("acked") + F.col("dead")).alias("drained"))


def by_queue(leases: DataFrame, queue: Column) -> DataFrame:
    """Record ids of a bounded set of leases by the queue they came from, in order."""
    return leases.select(queue.alias("queue"), "rec_id").groupBy("queue").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("rec_id")), ";").alias("rec_ids"))


def sample_queues(queues: list[DataFrame], size: int, n: int, seed: int) -> DataFrame:
    """Leases up to ``n`` records from ``size`` of the queues, drawn at random, the first drawn filled first."""
    drawn = np.random.default_rng(seed).permutation(len(queues))[:size].tolist()
    out = None
    for place, q in enumerate(drawn):
        some = lease(queues[q], n).select(F.lit(place).alias("place"), F.lit(q).alias("queue"), "rec_id")
        out = some if out is None else out.unionByName(some)
    return out.orderBy("place", "rec_id").limit(n).drop("place")
