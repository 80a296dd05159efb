"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.session import durable


def _linked(edges: DataFrame) -> DataFrame:
    """Links in both directions with the smallest node of each one's neighbourhood, itself included."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(smallest, "a")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in the links ``(a, b)``; the root is the component's smallest node.

    Links may repeat, in any direction; links of a node with itself and NULL ends say nothing. Every
    round is written to the shared folder and partially aggregated, so a node with very many links
    is no single group, and the rounds grow with the logarithm of the longest chain.
    """
    clean = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state, seen = durable(clean.distinct(), "links"), None
    while True:
        # Large star: each larger neighbour moves to the smallest node around.
        large = _linked(state).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # Small star: each smaller neighbour, and the node itself, moves to the smallest of them.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = lowest.select("a", F.col("m").alias("b"))
        state = durable(moved.filter("a <> b").unionByName(kept).distinct(), "links")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            roots = state.select("b", "b").distinct().toDF("node", "root")
            return state.toDF("node", "root").unionByName(roots)
        seen = now
