"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopworth.sources import pin


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for each node of an edge ``a, b``.

    Large-star and small-star steps in turn: every node tells its larger neighbours,
    then its smaller ones, of the least node it knows, until all edges point at the
    least node of their component. The rounds grow with the logarithm of the longest
    path. Minima combine before they are shuffled, joins on a node with many edges
    can be split, each round is written to the shared folder, and only counts reach
    the driver. Loops, repeated edges and null ends are ignored.
    """
    stars = pin(_ordered(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    state = _state(stars)
    while True:
        both = stars.union(stars.select("v", "u").toDF("u", "v"))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select("v", "m")
        large = large.toDF("u", "v").distinct()
        lower = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(lower, F.col("u") == F.col("w"))
        moved = small.select("v", "m").union(lower.select("w", "m")).toDF("u", "v")
        stars = pin(_ordered(moved))
        before, state = state, _state(stars)
        if state == before:
            break
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(stars.select("v", "v").distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    larger, smaller = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    return edges.where("u <> v").select(larger, smaller).distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and two checksums of a set of edges."""
    marks = [F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.sum(F.hash("v", "u").cast("bigint"))]
    return tuple(edges.agg(F.count("*"), *marks).first())
