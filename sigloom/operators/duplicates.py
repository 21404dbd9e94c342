"""Exact groups, near pairs by blocks in grid order, and their clusters."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.llm.egojoin import forest
from sigloom.llm.grouping import lists, runs
from sigloom.operators.order import with_ordinal
from sigloom.tables import written

#: Rows in a block, and rows of each side multiplied out at once.
BLOCK, TILE = 8192, 1024


def exact_groups(rows: DataFrame, content: str, id_: str) -> DataFrame:
    """Contents that several rows share: their hash, number and smallest id. Only hashes are shuffled, combined map-side."""
    out = rows.select(F.sha2(F.col(content), 256).alias("content_hash"), id_).groupBy("content_hash").agg(F.count("*").alias("n"), F.min(id_).alias("first_id"))
    return out.where("n > 1")


def keep_first(rows: DataFrame, content: str, id_: str) -> DataFrame:
    """The row with the smallest id of each content."""
    firsts = rows.groupBy(F.sha2(F.col(content), 256).alias("_h")).agg(F.min(id_).alias(id_))
    return rows.join(firsts.select(id_).distinct(), id_, "left_semi")


def _meeting(rows: DataFrame, id_: str, vector: str, near: Sequence[Column], tolerance: float, block: int) -> DataFrame:
    """Rows of each two blocks (i, j), i <= j, that come within ``tolerance`` of the other block's box: i, j, at, id, values, v.

    Rows are numbered in grid order of their ``near`` values and cut into blocks of ``block`` rows, so that
    a block is small however many rows share their values; rows that can have no near one are left out.
    """
    names = [f"_n{k}" for k in range(len(near))]
    v, values = F.col(vector), [c.cast("double") for c in near]
    base = rows.where(F.col(id_).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull()))
    base = base.select(F.col(id_).alias("id"), *(c.alias(n) for n, c in zip(names, values)), v.alias("v"))
    for n in names:
        base = base.where(F.abs(n) < float("inf"))
    grid = [F.floor(F.col(n) / (tolerance or 1.0)) for n in names[:-1]]
    dealt = with_ordinal(base, [*grid, names[-1], *names[:-1], "id"], "_at").withColumn("_block", F.floor(F.col("_at") / block))
    boxes = written(dealt.groupBy("_block").agg(*(f(n).alias(f"{e}{n}") for n in names for e, f in (("lo", F.min), ("hi", F.max)))), "boxes")
    other = boxes.toDF("_other", *(f"o{c}" for c in boxes.columns[1:]))
    close = [(F.col(f"lo{n}") - F.col(f"ohi{n}") <= tolerance) & (F.col(f"olo{n}") - F.col(f"hi{n}") <= tolerance) for n in names]
    partners = boxes.join(other, functools.reduce(Column.__and__, close)).select("_block", "_other", *other.columns[1:])
    sent = dealt.join(written(partners, "partners"), "_block")
    for n in names:
        sent = sent.where((F.col(n) - F.col(f"ohi{n}") <= tolerance) & (F.col(f"olo{n}") - F.col(n) <= tolerance))
    sent = sent.select(F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j"), F.col("_at").alias("at"), "id", F.array(*names).alias("values"), "v")
    # few bytes make much work here, so partitions must not be put together by their size
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent.repartition(parts, "i", "j").sortWithinPartitions("i", "j", "at")


class _Blocks:
    """Two blocks' rows with vectors of one length: what may be near is found in single precision, and decided in double."""

    def __init__(self, ids: pa.Array, near: np.ndarray, x: np.ndarray, cut: int, same: bool):
        self.ids, self.near, self.x, self.cut, self.same = ids, near, x, cut, same
        _, self.rank = np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)
        self.step = max(1, (1 << 21) // max(1, x.shape[1]))
        self.length, self.unit = np.zeros(len(x)), np.zeros(x.shape, np.float32)
        with np.errstate(all="ignore"):
            for k in range(0, len(x), self.step):
                y = x[k : k + self.step].astype(np.float64)
                self.length[k : k + self.step] = np.sqrt(in_order(y * y))
                self.unit[k : k + self.step] = y / self.length[k : k + self.step, None]
        #: vectors that single precision says nothing of: zero, not finite, very short or long
        self.odd = ~((self.length > 1e-100) & (self.length < 1e100))
        self.unit[self.odd] = 0

    def candidates(self, tolerance: float, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs of different ids, within ``tolerance`` and with a cosine that may be ``least``, each once."""
        near, n = self.near, len(self.near)
        limit = least - 1e-5 - 2e-7 * self.x.shape[1]
        left = [slice(k, min(k + TILE, self.cut)) for k in range(0, self.cut, TILE)]
        right = left if self.same else [slice(k, min(k + TILE, n)) for k in range(self.cut, n, TILE)]
        for a in left:
            for b in right:
                if self.same and a.start > b.start:
                    continue
                if (near[a].min(axis=0) - near[b].max(axis=0) > tolerance).any() or (near[b].min(axis=0) - near[a].max(axis=0) > tolerance).any():
                    continue
                may = self.unit[a] @ self.unit[b].T >= limit
                may[self.odd[a]] = True
                may[:, self.odd[b]] = True
                p, q = np.nonzero(may)
                p, q = p + a.start, q + b.start
                good = self.rank[p] != self.rank[q]
                if self.same:
                    good &= p < q
                p, q = p[good], q[good]
                for values in near.T:
                    good = np.abs(values[p] - values[q]) <= tolerance
                    p, q = p[good], q[good]
                for k in range(0, len(p), self.step):
                    yield p[k : k + self.step], q[k : k + self.step]

    def cosines(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return in_order(self.x[p].astype(np.float64) * self.x[q]) / (self.length[p] * self.length[q])


def in_order(x: np.ndarray) -> np.ndarray:
    """Sums of rows from left to right, as SQL engines add."""
    return np.cumsum(x, axis=1)[:, -1] if x.shape[1] else np.zeros(len(x))


def _blocks(batches: Iterable[pa.RecordBatch], block: int) -> Iterator[_Blocks]:
    for t in runs(batches, ["i", "j"]):
        at, (values, ends), (near, _) = t["at"].to_numpy(), lists(t["v"]), lists(t["values"])
        near = near.reshape(len(t), -1)
        size, i, j = np.diff(ends), t["i"][0].as_py(), t["j"][0].as_py()
        ids = t["id"].combine_chunks()
        for n in np.unique(size):
            rows = np.flatnonzero(size == n)
            x = values[ends[rows][:, None] + np.arange(n)]
            yield _Blocks(ids.take(pa.array(rows)), near[rows], x, int((at[rows] // block == i).sum()), i == j)


def _reaches(similarity: np.ndarray, least: float) -> np.ndarray:
    """NaN, which a vector of length zero or with a component that is not finite makes, is above every number as in SQL."""
    return (similarity >= least) | np.isnan(similarity)


def near_pairs(rows: DataFrame, id_: str, vector: str, near: Sequence[Column], tolerance: float, least: float, block: int = BLOCK) -> DataFrame:
    """Pairs of rows whose ``near`` values differ by ``tolerance`` at most and whose vectors have cosine ``least``.

    Blocks of rows in grid order meet where their boxes come within the tolerance, and are multiplied out there:
    only rows are dealt, a row once for each block near it, and pairs are made where they are decided.
    """
    kind = rows.schema[id_].dataType

    def met(batches):
        for blocks in _blocks(batches, block):
            for p, q in blocks.candidates(tolerance, least):
                similarity = blocks.cosines(p, q)
                good = _reaches(similarity, least)
                p, q, similarity = p[good], q[good], similarity[good]
                turned = blocks.rank[p] > blocks.rank[q]
                a, b = np.where(turned, q, p), np.where(turned, p, q)
                yield pa.record_batch([blocks.ids.take(pa.array(a)), blocks.ids.take(pa.array(b)), pa.array(similarity)], names=["a", "b", "similarity"])

    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("similarity", T.DoubleType())])
    return _meeting(rows, id_, vector, near, tolerance, block).mapInArrow(met, schema)


def near_clusters(rows: DataFrame, id_: str, vector: str, near: Sequence[Column], tolerance: float, least: float, block: int = BLOCK) -> DataFrame:
    """The :func:`clusters` of :func:`near_pairs`, of which two blocks give a forest alone: a link less than they have rows."""
    kind = rows.schema[id_].dataType

    def met(batches):
        for blocks in _blocks(batches, block):
            label = np.arange(len(blocks.rank))
            for p, q in blocks.candidates(tolerance, least):
                new = label[p] != label[q]
                p, q = p[new], q[new]
                good = _reaches(blocks.cosines(p, q), least)
                if good.any():
                    label = forest(len(label), np.concatenate([p[good], np.arange(len(label))]), np.concatenate([q[good], label]))
            linked = np.flatnonzero(blocks.rank != blocks.rank[label])
            yield pa.record_batch([blocks.ids.take(pa.array(linked)), blocks.ids.take(pa.array(label[linked]))], names=["a", "b"])

    links = _meeting(rows, id_, vector, near, tolerance, block).mapInArrow(met, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))
    return clusters(written(links, "links"))


def clusters(pairs: DataFrame) -> DataFrame:
    """id and cluster, the smallest id that pairs lead to.

    Each round takes the least label of the neighbours and then that label's own,
    which halves chains; labels are written every round, so that plans stay short.
    """
    edges = written(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("cluster")), "labels")
    while True:
        seen = edges.join(labels.select(F.col("id").alias("b"), F.col("cluster").alias("near")), "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        low = labels.join(seen, "id", "left").select("id", "cluster", F.least("cluster", F.coalesce("near", "cluster")).alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("cluster").alias("jumped"))
        after = written(low.join(jump, "low", "left").select("id", F.col("cluster").alias("old"), F.least("low", F.coalesce("jumped", "low")).alias("cluster")), "labels")
        labels = after.drop("old")
        if after.where("old <> cluster").isEmpty():
            return labels
