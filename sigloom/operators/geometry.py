"""Shape descriptors over tables of points (part, x, y, z), faces and edges."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions.scalars import SURFACE_TYPES, bin_of, clip, norm
from sigloom.operators.order import first_k

AXES = ("x", "y", "z")


def extents(points: DataFrame, part: str = "part") -> DataFrame:
    """Per part the number of points, their mean, and their least and largest coordinates: one aggregation, combined map-side."""
    return points.groupBy(part).agg(F.count("*").alias("n"), *(f(a).alias(f"{s}{a}") for a in AXES for s, f in (("m", F.avg), ("lo", F.min), ("hi", F.max))))


def normalised(points: DataFrame, part: str = "part") -> DataFrame:
    """Points moved to mean zero and divided by the bounding box's diagonal (plus 1e-9).

    An aggregation joined back rather than a window, so that a part with very many
    points does not meet in one task.
    """
    boxes = extents(points, part)
    diagonal = norm(*(F.col(f"hi{a}") - F.col(f"lo{a}") for a in AXES)) + F.lit(1e-9)
    out = points.join(boxes, part)
    return out.select(*(c for c in points.columns if c not in AXES), "n", *(((F.col(a) - F.col(f"m{a}")) / diagonal).alias(a) for a in AXES))


def box_ratios(points: DataFrame, part: str = "part") -> DataFrame:
    """The two smaller extents over the largest (plus 1e-12)."""
    sides = F.array_sort(F.array(*(F.col(f"hi{a}") - F.col(f"lo{a}") for a in AXES)))
    largest = F.get(sides, F.lit(2)) + F.lit(1e-12)
    return extents(points, part).select(part, "n", (F.get(sides, F.lit(0)) / largest).alias("r1"), (F.get(sides, F.lit(1)) / largest).alias("r2"))


def distance_histogram(points: DataFrame, partner: Column, part: str = "part", bins: int = 64) -> DataFrame:
    """Counts of the distances between each normalised point ``idx`` and its ``partner`` (an expression of idx and n).

    Distances are over the square root of three, clipped to [0, 1]. ``points`` has
    idx, numbering each part's points from 0. Parts of fewer than four points have none.
    """
    unit = normalised(points, part).where("n >= 4")
    left = unit.withColumn("mate", partner)
    right = unit.select(F.col(part), F.col("idx").alias("mate"), *(F.col(a).alias(f"{a}2") for a in AXES))
    gap = norm(*(F.col(a) - F.col(f"{a}2") for a in AXES)) / F.lit(math.sqrt(3) + 1e-9)
    found = left.join(right, [part, "mate"]).select(part, bin_of(clip(gap, 0.0, 1.0), 0.0, 1.0, bins).alias("bin"))
    return found.groupBy(part, "bin").agg(F.count("*").alias("cnt"))


def drawn_histogram(points: DataFrame, part: str = "part", pairs: int = 20_000, bins: int = 64, seed: int = 0) -> DataFrame:
    """Counts of the distances of ``pairs`` drawn pairs (i, j), i = j allowed, of each part's normalised points.

    ``points`` has idx from 0 and at most a few thousand points of a part, which fit one array; pair k is
    (k * 7919 + seed, k * 104729 + k div n + 13) modulo n. Parts of fewer than four points have none.
    """
    # few bytes make much work here, so partitions must not be put together by their size
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unit = normalised(points, part).where("n >= 4").repartition(parts, part)
    rows = unit.groupBy(part).agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", *AXES))), lambda p: F.struct(*(p[a] for a in AXES))).alias("p"))
    n = F.size("p").cast("long")

    def bin_at(k: Column) -> Column:
        a, b = F.get("p", F.pmod(k * 7919 + seed, n).cast("int")), F.get("p", F.pmod(k * 104729 + F.floor(k / n) + 13, n).cast("int"))
        return bin_of(clip(norm(*(a[c] - b[c] for c in AXES)) / F.lit(math.sqrt(3) + 1e-9), 0.0, 1.0), 0.0, 1.0, bins)

    found = rows.select(part, F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(pairs - 1).cast("long")), bin_at)).alias("bin"))
    return found.groupBy(part, "bin").agg(F.count("*").alias("cnt"))


def dense(histogram: DataFrame, part: str, bins: int) -> DataFrame:
    """One array of ``bins`` shares per part, zeros filled in."""
    entries = F.map_from_entries(F.collect_list(F.struct("bin", "cnt")))
    out = histogram.groupBy(part).agg(entries.alias("m"), F.sum("cnt").alias("total"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.coalesce(F.element_at("m", b), F.lit(0)) / (F.col("total") + F.lit(1e-12)))
    return out.select(part, filled.alias("hist"))


def surface_histogram(faces: DataFrame, part: str = "part", kind: str = "surface_type") -> DataFrame:
    """Shares of the surface types, in fixed order, of at least one face."""
    total = F.greatest(F.count("*"), F.lit(1))
    known = F.when(F.col(kind).isin(*SURFACE_TYPES[:-1]), F.col(kind)).otherwise(SURFACE_TYPES[-1])
    return faces.withColumn("_k", known).groupBy(part).agg(*((F.count_if(F.col("_k") == s) / total).alias(s) for s in SURFACE_TYPES))


def edge_pairs(edges: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The first two faces at each edge as columns ``<c>_a`` and ``<c>_b``; edges with one face are left out."""
    two = first_k(edges.select(*dict.fromkeys([*keys, *order, *keep])), keys, order, 2)
    pick = lambda c, r: F.max(F.when(F.col("rank") == r, F.col(c)))
    out = two.groupBy(*keys).agg(F.max("rank").alias("_n"), *(pick(c, r).alias(f"{c}_{s}") for c in keep for r, s in ((1, "a"), (2, "b"))))
    return out.where("_n = 2").drop("_n")


def dihedral_histogram(pairs: DataFrame, part: str = "part", bins: int = 36, normal: Sequence[str] = ("nx", "ny", "nz"), flipped: str | None = None) -> DataFrame:
    """Counts of the angles between the normals at each edge; pairs with an undefined normal are left out.

    Normals of faces whose column ``flipped`` is true (reversed orientation) count with the other sign.
    """
    a, b = ([F.col(f"{c}_{s}") * (F.when(F.col(f"{flipped}_{s}"), -1.0).otherwise(1.0) if flipped else F.lit(1.0)) for c in normal] for s in "ab")
    la, lb = norm(*a) + F.lit(1e-12), norm(*b) + F.lit(1e-12)
    dot = sum(((p / la) * (q / lb) for p, q in zip(a[1:], b[1:], strict=True)), (a[0] / la) * (b[0] / lb))
    angle = F.acos(clip(dot, -1.0, 1.0))
    defined = [c.isNotNull() for c in (*a, *b)]
    for c in defined[1:]:
        defined[0] = defined[0] & c
    return pairs.where(defined[0]).select(part, bin_of(angle, 0.0, math.pi, bins).alias("bin")).groupBy(part, "bin").agg(F.count("*").alias("cnt"))


def value_hash(*values: Column, scale: int = 1000) -> Column:
    """SHA-256 of the values as whole thousandths, comma-separated: the same text in any engine."""
    return F.sha2(F.concat_ws(",", *(F.coalesce(F.round(v * scale).cast("long").cast("string"), F.lit("")) for v in values)), 256)


def signature_rows(points: DataFrame, part: str = "part") -> DataFrame:
    """A row per part: whether it has enough points, and its ratios, which are null below four points."""
    enough = F.col("n") >= 4
    ratios = (F.when(enough, F.round(r, 6)).alias(r) for r in ("r1", "r2"))
    return box_ratios(points, part).select(F.col(part).cast("string").alias("part_id"), F.when(enough, 1).otherwise(0).alias("has_points"), *ratios)
