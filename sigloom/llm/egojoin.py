"""Operator 9: near-duplicate vectors by an epsilon grid order join.

Unit vectors are turned to principal axes and sorted by the grid cells (of side
epsilon, the distance that the least cosine stands for) of their leading axes.
The sorted sequence is cut into blocks. Sequences are joined by halving them again and
again and skipping halves whose boxes are further apart than epsilon: first intervals of blocks,
then the blocks of two such intervals, then the vectors of two blocks, of which only those meet in a task that come
within epsilon of the other block's box. What is left is multiplied
out in single precision, and pairs near the limit or above are decided in double.
Equal vectors are one class with a size.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.llm.components import components
from sigloom.llm.grouping import runs
from sigloom.llm.labelled import thinned
from sigloom.llm.shared import bounded, dropped, written
from sigloom.llm.vectors import matrix, usable

BLOCK, LEAF, AXES, SAMPLE = 4096, 512, 8, 20_000
#: Blocks in an interval, and boxes compared at once.
INTERVAL, BOXES = 256, 64


def axes(rows: DataFrame) -> np.ndarray:
    """Principal axes of about SAMPLE vectors; any rotation gives right results, a good one skips more."""
    some = thinned(rows.select("v"), SAMPLE).toArrow()
    if not some.num_rows:
        return np.eye(1)
    x = matrix(some["v"])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    _, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    return vectors[:, ::-1].copy()


def turned(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Coordinates on the leading axes, and the length of the rest as one more."""
    y = x @ rotation[:, :AXES]
    return np.column_stack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))])


def apart(low_a, high_a, low_b, high_b) -> float:
    """Squared distance of two boxes."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float((gap * gap).sum())


def joined(a: np.ndarray, b: np.ndarray, ya: np.ndarray, yb: np.ndarray, least: float, same: bool):
    """Index pairs (i, j) with cosine of ``least`` or more; with ``same`` each once, i < j."""
    limit = (2 - 2 * least) * (1 + 1e-9) + 1e-9
    a4, b4 = a.astype(np.float32), b.astype(np.float32)
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if i >= j or k >= m or same and m <= i + 1:
            continue
        if apart(ya[i:j].min(axis=0), ya[i:j].max(axis=0), yb[k:m].min(axis=0), yb[k:m].max(axis=0)) > limit:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            p, q = np.nonzero(a4[i:j] @ b4[k:m].T >= least - 1e-4)
            p, q = p + i, q + k
            if same:
                p, q = p[p < q], q[p < q]
            for at in range(0, len(p), 1 << 16):
                u, v = p[at : at + (1 << 16)], q[at : at + (1 << 16)]
                good = np.einsum("ij,ij->i", a[u], b[v]) >= least
                yield u[good], v[good]
            continue
        h, n = (i + j) // 2, (k + m) // 2
        left = [(i, h), (h, j)] if j - i > LEAF else [(i, j)]
        right = [(k, n), (n, m)] if m - k > LEAF else [(k, m)]
        todo += [(*x, *y) for x in left for y in right]


def near_boxes(a: np.ndarray, b: np.ndarray, limit: float, same: bool):
    """Index pairs (i, j) of boxes (low, high) with a squared distance of ``limit`` at most; with ``same`` each once, i <= j."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if i >= j or k >= m or same and m <= i:
            continue
        if apart(a[i:j, 0].min(axis=0), a[i:j, 1].max(axis=0), b[k:m, 0].min(axis=0), b[k:m, 1].max(axis=0)) > limit:
            continue
        if j - i <= BOXES and m - k <= BOXES:
            x, y = a[i:j, None], b[None, k:m]
            gap = np.maximum(0, np.maximum(x[:, :, 0] - y[:, :, 1], y[:, :, 0] - x[:, :, 1]))
            p, q = np.nonzero((gap * gap).sum(axis=-1) <= limit)
            keep = (p + i <= q + k) if same else slice(None)
            out.append(np.column_stack([p + i, q + k])[keep])
            continue
        h, n = (i + j) // 2, (k + m) // 2
        left = [(i, h), (h, j)] if j - i > BOXES else [(i, j)]
        right = [(k, n), (n, m)] if m - k > BOXES else [(k, m)]
        todo += [(*x, *y) for x in left for y in right]
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def block_pairs(boxes: DataFrame, limit: float) -> DataFrame:
    """Pairs (i, j), i <= j, of blocks whose boxes come that near; ``boxes`` has block and box (low, then high ends)."""

    def stacked(t: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
        t = t.sort_by(column)
        return t[column].to_numpy(), matrix(t["box"]).reshape(len(t), 2, -1)

    def intervals(batches):
        t = pa.Table.from_batches(list(batches), pa.schema([("block", pa.int32()), ("box", pa.list_(pa.float64()))]))
        if len(t):
            names, a = stacked(t, "block")
            s = names // INTERVAL
            begin = np.flatnonzero(np.diff(s, prepend=-1))
            whole = np.stack([np.minimum.reduceat(a[:, 0], begin), np.maximum.reduceat(a[:, 1], begin)], axis=1)
            yield pa.record_batch([pa.array(s[begin]), pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1) * whole[0].size, pa.int32()), pa.array(whole.ravel()))], names=["block", "box"])

    def near(batches):
        # one row for INTERVAL * BLOCK vectors
        t = pa.Table.from_batches(list(batches), pa.schema([("block", pa.int32()), ("box", pa.list_(pa.float64()))]))
        if len(t):
            names, a = stacked(t, "block")
            found = near_boxes(a, a, limit, True)
            yield pa.record_batch([pa.array(names[found[:, 0]]), pa.array(names[found[:, 1]])], names=["s", "t"])

    def meet(t: pa.Table) -> pa.Table:
        same = t["s"][0].as_py() == t["t"][0].as_py()
        (i, a), (j, b) = (stacked(t.filter(pc.equal(t["side"], side)), "block") for side in (0, 0 if same else 1))
        found = near_boxes(a, b, limit, same)
        return pa.table({"i": pa.array(i[found[:, 0]]), "j": pa.array(j[found[:, 1]])})

    boxes = boxes.withColumn("s", F.floor(F.col("block") / INTERVAL).cast("int"))
    kind = "block int, box array<double>"
    wide = boxes.repartition("s").sortWithinPartitions("s").select("block", "box").mapInArrow(intervals, kind)
    outer = written(wide.coalesce(1).mapInArrow(near, "s int, t int"), "intervals")
    left = boxes.join(outer, "s").select("s", "t", F.lit(0).alias("side"), "block", "box")
    right = boxes.withColumnRenamed("s", "t").join(outer.where("s <> t"), "t").select("s", "t", F.lit(1).alias("side"), "block", "box")
    return left.unionByName(right).groupBy("s", "t").applyInArrow(meet, "i int, j int")


def forest(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For every index the smallest one that the pairs connect it with."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, p, label[q])
        np.minimum.at(label, q, label[p])
        label = label[label]
        if (label == before).all():
            return label


def near_duplicates(rows: DataFrame, least: float = 0.95) -> DataFrame:
    """Per row vec_id, n_links, component_id, kept, of links with cosine ``least`` or more.

    n_links counts other rows linked directly. Vectors that are null, empty, zero, of another
    length than most, or hold null or non-finite components link with nothing, nor do
    rows without id, whose component is null and which are not kept. Rows that
    repeat a vec_id are linked like different rows. Extra columns are ignored.
    """
    bounded(rows.sparkSession)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    rows = rows.withColumn("usable", usable(rows, "v", zero=False))
    good = rows.where("usable").drop("usable")

    def name(batches):
        for b in batches:
            x = matrix(b.column(1)) + 0.0 if b.num_rows else np.zeros((0, 1))
            keys = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(keys, pa.binary())], names=["vec_id", "v", "key"])

    named = written(good.mapInArrow(name, T.StructType([*good.schema.fields, T.StructField("key", T.BinaryType())])), "vectors")
    # a class has a number of its own, as its smallest vec_id may be that of other vectors too
    classes = named.groupBy("key").agg(F.min("vec_id").alias("first"), F.count("*").alias("size"), F.first("v").alias("v"))
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    members = written(named.select("vec_id", "key").join(classes.drop("v"), "key").select("vec_id", "rep", "size"), "members")
    dropped(named)
    reps = classes.select("rep", "size", "v")
    rotation = axes(reps)
    shared = rows.sparkSession.sparkContext.broadcast(rotation)
    epsilon = math.sqrt(2 - 2 * least)

    def place(batches):
        for b in batches:
            if b.num_rows:
                x = matrix(b.column(2))
                y = turned(x / np.linalg.norm(x, axis=1, keepdims=True), shared.value)
                width = y.shape[1]
                cells = [pa.array(c) for c in np.floor(y / epsilon).astype(np.int32).T]
                yield pa.record_batch([*b.columns[:3], *cells, pa.array(y[:, 0]), pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * width, pa.int32()), pa.array(y.ravel()))], names=["rep", "size", "v", *(f"g{i}" for i in range(width)), "y0", "y"])

    kind = reps.schema["v"].dataType.simpleString()
    width = min(AXES, rotation.shape[0]) + 1
    grid = [f"g{i}" for i in range(width)]
    placed = written(reps.select("rep", "size", "v").mapInArrow(place, f"rep long, size long, v {kind}, {', '.join(f'{g} int' for g in grid)}, y0 double, y array<double>"), "placed")
    n = placed.count()
    blocks = max(1, -(-n // BLOCK))
    # partitions that follow each other make up a block, however many partitions there are
    parts = written(placed.repartitionByRange(4 * blocks, *grid, "y0", "rep").select("rep", "size", "v", "y", F.spark_partition_id().alias("part")), "parts")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    block_of = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.floor(before / BLOCK).cast("int").alias("block"))
    dealt = parts.join(block_of, "part").select("rep", "size", "v", "y", "block")
    ends = [f(F.get("y", F.lit(i))) for f in (F.min, F.max) for i in range(width)]
    boxes = written(dealt.groupBy("block").agg(F.array(*ends).alias("box")), "boxes")
    limit = epsilon**2 * (1 + 1e-9) + 1e-9
    pairs = written(block_pairs(boxes, limit).where("i <> j"), "pairs")
    both = pairs.unionByName(pairs.select(F.col("j").alias("i"), F.col("i").alias("j")))
    partners = both.join(boxes.withColumnRenamed("block", "j"), "j").groupBy(F.col("i").alias("block")).agg(F.collect_list(F.struct("j", "box")).alias("partners"))
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("side", T.IntegerType()), *(dealt.schema[c] for c in ("rep", "size", "v"))])

    def sent(vectors: pa.Table, partners: pa.Table) -> pa.Table:
        """A block's vectors for itself, and for every other block those that come within epsilon of its box."""
        own = vectors.select(["rep", "size", "v"])
        if not len(own):
            return pa.table({"i": pa.array([], pa.int32()), "j": pa.array([], pa.int32()), "side": pa.array([], pa.int32()), **{c: own[c] for c in own.column_names}})
        block, y = vectors["block"][0].as_py(), matrix(vectors["y"])
        parts = [(block, block, 0, np.arange(len(y)))]
        for p in partners["partners"][0].as_py() if len(partners) else []:
            box = np.array(p["box"]).reshape(2, -1)
            gap = np.maximum(0, np.maximum(box[0] - y, y - box[1]))
            rows = np.flatnonzero((gap * gap).sum(axis=1) <= limit)
            parts.append((min(block, p["j"]), max(block, p["j"]), int(block > p["j"]), rows))
        n = [len(rows) for *_, rows in parts]
        named = {c: pa.array(np.repeat([p[k] for p in parts], n), pa.int32()) for k, c in enumerate(("i", "j", "side"))}
        chosen = own.take(pa.array(np.concatenate([rows for *_, rows in parts])))
        return pa.table({**named, **{c: chosen[c] for c in own.column_names}})

    def meet(batches):
        for g in runs(batches, ["i", "j"]):
            side, rep, size, x = g["side"].to_numpy(), g["rep"].to_numpy(), g["size"].to_numpy(), matrix(g["v"])
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            same = g["i"][0].as_py() == g["j"][0].as_py()
            y = turned(x, shared.value)
            order = np.lexsort((rep, *(np.floor(y / epsilon).T[::-1]), side))
            side, rep, size, x, y = side[order], rep[order], size[order], x[order], y[order]
            cut = len(rep) if same else int((side == 0).sum())
            if not cut or not same and cut == len(rep):
                continue
            second = slice(0, None) if same else slice(cut, None)
            label, links = np.arange(len(rep)), np.zeros(len(rep), np.int64)
            for p, q in joined(x[:cut], x[second], y[:cut], y[second], least, same):
                q = q if same else q + cut
                links += np.bincount(p, size[q], len(rep)).astype(np.int64) + np.bincount(q, size[p], len(rep)).astype(np.int64)
                root = forest(len(rep), np.concatenate([p, np.arange(len(rep))]), np.concatenate([q, label]))
                label = root
            some = links > 0
            # label points at the row that comes first in the block order, any one will do to connect
            yield pa.record_batch([pa.array(rep[some]), pa.array(links[some]), pa.array(rep[label[some]])], names=["a", "links", "b"])

    met = dealt.groupBy("block").cogroup(partners.groupBy("block")).applyInArrow(sent, schema)
    found = written(met.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(meet, "a long, links long, b long"), "links")
    dropped(placed, parts, boxes, pairs)
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    linked = components(found.select("a", "b")).withColumnRenamed("id", "rep")
    known = classes.select("rep", "first").join(counts, "rep", "left").join(linked, "rep", "left").select("rep", "first", "links", F.coalesce("component", "rep").alias("component"))
    known = written(known, "known")
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = written(known.join(smallest, "component").select("rep", "links", "component_id"), "known")
    out = members.join(known, "rep").select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    rest = rows.where("not usable")
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
