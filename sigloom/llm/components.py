"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """Columns id and component (smallest id reachable) for every id in ``links`` (a, b).

    Alternates two rewritings of the links, each a grouped minimum and an
    equi-join: all larger neighbours of an id move to its smallest neighbour, then
    all smaller ones do. The links end as stars; the rounds grow with the
    logarithm of the longest chain.
    """
    x, y = F.greatest("a", "b"), F.least("a", "b")
    edges = written(links.where("a <> b").select(x.alias("u"), y.alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        small = moved.select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).where("u <> v")
        own = low.select("u", F.col("m").alias("v"))
        after = written(small.unionByName(own).where("u <> v").distinct(), "links")
        same = after.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(after, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
