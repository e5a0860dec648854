"""Connected components of a graph given by its edges: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.support import stored


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Hang neighbours on the smallest: all larger neighbours of a node, or the node and its smaller neighbours."""
    sides = edges.select("u", "v")
    if both:
        sides = sides.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = sides.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sides.join(least, "u")
    if both:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node with an edge to another.

    edges has long columns u and v; loops, repeated and reversed edges do not matter. Each step shuffles edges only and
    is stored; the number of steps grows with the logarithm of the longest path.
    """
    now = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    state = None
    while True:
        now = stored(_star(_star(now, True), False), "edges")
        new = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if new == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = new
