"""Connected components by alternating large-star and small-star steps.

Each step is one aggregation and one join over the edges; no node's neighbours are gathered in one place.
A step hangs neighbours on the smallest node around, so chains shorten
by half each time and a star is final after one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v); the component is its smallest node."""
    state = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        found = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
        state = materialise(_small_star(_large_star(state).distinct()).distinct())
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(state.select("v", "v")).distinct()
