"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postweave.session import pin


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (
        down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b), the component named by its smallest node.

    Alternating stars: each round shortens all paths, so the number of rounds grows with the logarithm of the longest one. Sums
    over neighbours are pre-aggregated, and every round is pinned.
    """
    edges = pin(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # Stars are reached when a round changes neither the number of links nor the sum of their ends.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges = pin(_small_star(_large_star(edges)))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
