"""Connected components of an undirected graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the component's least node.

    Each step only groups, joins and makes rows distinct; a hub is combined before the shuffle and
    its join is split by adaptive execution. The edges of each round are written to the shared
    folder. They end as stars around the roots, after a number of rounds that grows with the
    logarithm of the longest path.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    links = stored(links.distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == before or not state["n"]:
            roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        before = (state["n"], state["h"])
        links = stored(_small_star(_large_star(links)), "links")


def _large_star(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on its least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).filter("a <> b").distinct()
