"""Whole jobs: from point tables or files to a written result and its summary."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.operators import fingerprints, geometry, order, packing
from sigloom.sources import files, sinks
from sigloom.streaming.progress import counted


@dataclasses.dataclass(frozen=True)
class Parameters:
    """Settings of the signature job, with the defaults in use."""

    sample_points: int = 4096
    pairs: int = 20_000
    bins: int = 64
    angle_bins: int = 36
    seed: int = 0


def descriptors(points: DataFrame, faces: DataFrame, edges: DataFrame, parameters: Parameters = Parameters()) -> DataFrame:
    """A row per part with all four descriptors, their hash and an error text.

    ``points`` (part, idx, x, y, z), ``faces`` (part, surface_type), ``edges``
    (part, edge, seq, nx, ny, nz and, where orientation is known, reversed); an edge's key may be any value or struct. Parts of
    fewer than four points have has_points 0, no descriptors and an error that says so. Large clouds are sampled by a hash of part and idx.
    """
    p = parameters
    some = order.sample_k(points, ["part"], F.struct(packing.hashed(F.lit(p.seed), F.col("part"), F.col("idx")).alias("h"), "idx"), p.sample_points)
    from pyspark.sql import Window

    some = some.withColumn("idx", F.row_number().over(Window.partitionBy("part").orderBy("idx")) - 1)  # sample_points rows at most
    base = geometry.signature_rows(some).select("part_id", "has_points", F.array("r1", "r2").alias("bbox_ratio"), F.when(F.col("has_points") == 1, "").otherwise("too_few_points").alias("error"))
    text = lambda df: df.withColumn("part", F.col("part").cast("string"))
    d2 = geometry.dense(text(geometry.drawn_histogram(some, "part", p.pairs, p.bins, p.seed)), "part", p.bins)
    surf = geometry.surface_histogram(text(faces)).select("part", F.array(*geometry.SURFACE_TYPES).alias("surf"))
    flip = "reversed" in edges.columns
    pairs = geometry.edge_pairs(text(edges), ["part", "edge"], ["seq"], ["nx", "ny", "nz", *(["reversed"] if flip else [])])
    dih = geometry.dense(geometry.dihedral_histogram(pairs, bins=p.angle_bins, flipped="reversed" if flip else None), "part", p.angle_bins)
    out = base.withColumnRenamed("part_id", "part")
    for df, name, size in ((d2, "d2_hist", p.bins), (surf, "surf_hist", 6), (dih, "dih_hist", p.angle_bins)):
        column = [c for c in df.columns if c != "part"][0]
        out = out.join(df.withColumnRenamed(column, name), "part", "left").withColumn(name, F.when(F.col("has_points") == 1, F.coalesce(name, F.array_repeat(F.lit(0.0), size))))
    out = out.withColumn("bbox_ratio", F.when(F.col("has_points") == 1, F.col("bbox_ratio")))
    # thousandths, rounded half to even
    rounded = F.transform(F.concat("d2_hist", "bbox_ratio", "surf_hist", "dih_hist"), lambda v: F.rint(v * 1000).cast("long").cast("string"))
    out = out.withColumn("values", F.coalesce(F.array_join(rounded, ","), F.lit("")))
    return out.withColumn("geom_hash", F.when(F.col("values") != "", F.sha2("values", 256)).otherwise("")).withColumnRenamed("part", "part_id")


def run(rows: DataFrame, path: str, before: Callable[[], None] | None = None, after: Callable[[dict], None] | None = None) -> dict:
    """Write ``rows`` as CSV under ``path`` and give {rows, fingerprint, output}; no output for an empty relation.

    Each run has its own path, so leftovers of others never count. Hooks run on the driver.
    """
    if before:
        before()
    watched, seen = counted(rows)
    sinks.write_csv(watched, path)
    written = files.read_csv_parts(rows.sparkSession, path, sinks.flat(rows).schema)
    summary = fingerprints.aggregate_outputs(written).first().asDict()
    if summary["rows"] != seen.get["rows"]:
        raise RuntimeError(f"{seen.get['rows']} rows written, {summary['rows']} read back")
    summary["output"] = path if summary["rows"] else None
    if after:
        after(summary)
    return summary


def example(spark: SparkSession, items_path: str, out: str, tasks: int = 12, chunk: int = 1) -> dict:
    """Items repeated to ``tasks * chunk``, packed by number, one row per task and a total; written as JSON."""
    items = order.cyclic(files.read_items(spark, items_path), ["part_id"], tasks * chunk, "part_id")
    packed = packing.fixed(items, ["copy", "part_id"], chunk)
    built = packing.tasks(packed, ["task_idx"], "part_id", "ordinal", "weight")
    sinks.write_final(built.select("task_id", "n_items", "weight"), out)
    return packing.totals(built).first().asDict()
