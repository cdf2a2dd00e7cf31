"""Connected components of a graph given as rows of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has that one only, and is no smaller neighbour itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours go to the least of it and its neighbours.

    A node may have a third of all edges, so the least neighbours are written out: the join back can then be split.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")), "least-neighbour").select("u", F.least("u", "m").alias("m"))
    met = both.join(least, "u").where(F.col("v") > F.col("u"))
    return met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the least of these. Few edges lead down from any one node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    met = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` (longs) to ``node, component``: every node with an edge to its component's least node, that one too.

    Alternates large-star and small-star steps until all edges lead from a node to its component's least one: none if
    they do from the start, else a few rounds of a few shuffles of the edges. Each round is written to the shared
    folder, so no lineage builds up.
    """
    turned = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = staged(turned.distinct(), "component-edges")
    while not _all_stars(now):
        large = staged(_large_star(now), "component-large")
        now = staged(_small_star(large), "component-small")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
