"""Operator 4: exact top-k inner products by the threshold algorithm.

Rows are dealt into blocks; in a block every dimension has a list of the rows in
the order of that component. For a query the lists are read together, each from
the end that its weight favours; rows that turn up are scored in full. What no list
has shown yet scores at most the sum of weight times value at the reading
depth; reading stops when that is below the kth result so far. Each
block of queries meets each block of rows in one task; results are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.grouping import runs
from sigloom.llm.vectors import matrix, usable

#: Rows and queries in a block, and the depth first read to; it doubles from step to step, so that at most twice the depth needed is read.
ROWS, QUERIES, STEP = 8192, 2048, 4


class Lists:
    """A block's rows and, for every dimension, their order by that component."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.order = np.argsort(self.values, axis=0, kind="stable").T.copy()
        self.exact = float(np.abs(values).max(initial=0)) ** 2 * values.shape[1] < 2.0**53
        self.scored = 0
        self.whole = self.values if self.exact else self.values.astype(np.int64)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) but the rows of id ``own``: larger scores first, then smaller ids."""
        n = len(self.ids)
        weight = query if self.exact else query.astype(np.int64)
        down = query > 0
        seen = self.ids == own
        best, score = np.zeros(0, np.int64), np.zeros(0, weight.dtype)
        stop = 0
        while stop < n:
            depth, stop = stop, min(n, 2 * stop or STEP)
            read = np.where(down[:, None], self.order[:, ::-1][:, depth:stop], self.order[:, depth:stop])
            fresh = np.zeros(n, bool)
            fresh[read.ravel()] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh)
            self.scored += len(rows)
            best = np.concatenate([best, rows])
            score = np.concatenate([score, self.whole[rows] @ weight])
            if len(best) > k:
                # rows are in the order of ids, so a stable order by score keeps the smaller id first
                keep = np.lexsort((best, -score))[:k]
                best, score = best[keep], score[keep]
            last = read[:, -1]
            bound = (self.whole[last, np.arange(len(last))] * weight).sum()
            if len(best) >= k and score[-1] > bound:
                break
        keep = np.lexsort((best, -score))[:k]
        return self.ids[best[keep]], score[keep].astype(np.int64)


def top_k(rows: DataFrame, every: int = 100, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` best among all other rows.

    Components are floor(scale * x); queries are the rows whose vec_id is
    divisible by ``every``. Rows without id or with vectors that are null, empty, of another
    length than most, or hold null or non-finite components take no part. Rows that
    repeat an id are candidates each, and none of them for a query of that id;
    repeated query rows count once. Fewer rows give fewer results, none an empty table. Scores are
    exact while they fit 64 bits.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    good = rows.where(usable(rows, "v"))
    n = good.count()
    queries = good.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    blocks, groups = max(1, -(-n // ROWS)), max(1, -(-queries.count() // QUERIES))
    key = F.xxhash64("vec_id", "v")
    # rows that repeat are dealt apart
    dealt = good.withColumn("key", key).withColumn("block", F.pmod(F.xxhash64("key", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    side = dealt.select(F.lit(0).alias("side"), "key", "vec_id", "v", "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    asked = queries.select(F.lit(1).alias("side"), key.alias("key"), "vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod("key", F.lit(groups)).cast("int").alias("group"))

    def run(batches):
        for g in runs(batches, ["block", "group"]):
            side, key, ids, values = g["side"].to_numpy(), g["key"].to_numpy(), g["vec_id"].to_numpy(), np.floor(scale * matrix(g["v"]))
            rows = side == 0
            if not rows.any() or rows.all():
                continue
            lists = Lists(ids[rows], values[rows])
            out = [[], [], [], []]
            for i in np.flatnonzero(~rows):
                found, score = lists.search(values[i], ids[i], k)
                for column, x in zip(out, (np.full(len(found), key[i]), np.full(len(found), ids[i]), found, score), strict=True):
                    column.append(x)
            yield pa.record_batch([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["key", "query_id", "vec_id", "score"])

    met = side.unionByName(asked).repartition("block", "group").sortWithinPartitions("block", "group")
    found = met.mapInArrow(run, "key long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
