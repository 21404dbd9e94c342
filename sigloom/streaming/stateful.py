"""The queue fold and the burst limiter over unbounded input, with the batch versions' own step functions."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.operators.logs import Burst
from sigloom.operators.queue import Record

#: Files in a micro-batch at most; a key's rows of one micro-batch are put in order in memory.
FILES = 64
#: Rows that a key gives at once.
CHUNK = 10_000
_RECORD = "acked boolean, known boolean, dead boolean, attempts int, lease_until double, visible_at double"


def queue_states(log: DataFrame, max_attempts: int = 0, retry_delay: float = 0.0) -> DataFrame:
    """A record's state after each micro-batch that holds operations of it (update mode).

    ``log`` is a stream of rec_id, seq, ts, op, arg. State is one record's few numbers;
    operations of a micro-batch are put in order, and ones that come in a later
    micro-batch than newer ones are applied then.
    """

    def step(key, batches: Iterator[pd.DataFrame], state):
        record = Record(*state.get) if state.exists else Record()
        now = 0.0
        # a key's operations of one micro-batch, which FILES bounds, as bare numbers
        rows = sorted(row for b in batches for row in zip(b["ts"], b["seq"], b["op"], b["arg"].fillna(0.0), strict=True))
        for ts, _, op, arg in rows:
            record.apply(op, ts, arg, max_attempts, retry_delay)
            now = max(now, ts)
        state.update(dataclasses.astuple(record))
        yield pd.DataFrame([(key[0], record.status(now), record.attempts, record.lease_until, record.visible_at, record.dead)], columns=["rec_id", "status", "attempts", "lease_until", "visible_at", "dead"])

    out = "rec_id long, status string, attempts int, lease_until double, visible_at double, dead boolean"
    return log.groupBy("rec_id").applyInPandasWithState(step, out, _RECORD, "update", "NoTimeout")


def burst_limited(events: DataFrame, key: str, ts: str, id_: str, burst: int, interval: float) -> DataFrame:
    """key, id, admitted for every event of a stream (append mode); state is ``burst`` times at most."""

    def step(key_, batches: Iterator[pd.DataFrame], state):
        window = Burst(burst, interval, state.get[0] if state.exists else ())
        rows = np.concatenate([b[["_ts", "_id"]].to_records(index=False) for b in batches])
        rows.sort(order=["_ts", "_id"])
        admitted = [window.admit(t) for t in rows["_ts"].tolist()]
        state.update((list(window.admitted),))
        for i in range(0, len(rows), CHUNK):
            yield pd.DataFrame({"key": key_[0], "id": rows["_id"][i : i + CHUNK], "admitted": admitted[i : i + CHUNK]})

    rows = events.select(F.col(key).alias("_key"), F.col(ts).cast("timestamp").cast("double").alias("_ts"), F.col(id_).cast("long").alias("_id"))
    out = rows.groupBy("_key").applyInPandasWithState(step, "key string, id long, admitted boolean", "admitted array<double>", "append", "NoTimeout")
    return out.toDF(key, id_, "admitted")


def drain(stream: DataFrame, mode: str, folder: str) -> DataFrame:
    """Run a stream over what there is now into Parquet under ``folder`` and read that.

    A micro-batch that is done again after a failure overwrites its own part, so every row comes once. The driver
    holds no rows; the checkpoint lies in the same folder, so a restart goes on where the stream stopped.
    """

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    spark = stream.sparkSession
    try:
        return spark.read.schema(stream.schema).parquet(f"{folder}/rows").select(*stream.columns)
    except AnalysisException:  # no micro-batch had anything
        return spark.createDataFrame([], stream.schema)


def parquet_stream(spark, path: str, columns: Sequence[str]) -> DataFrame:
    """A Parquet file or folder as a stream, its schema as stored."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", False).parquet(f"{folder}/{name}*").select(*columns)
