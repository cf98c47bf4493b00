"""Connected components of a link table, in rounds of large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waymark.llm.store import checkpointed


def _star(edges: DataFrame) -> DataFrame:
    """One round over links (a, b) with a > b: every node is moved to the smallest node it can see."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Links (a, b) of numbers to (node, root): the smallest node each linked node can reach; links to itself and null links count for nothing.

    Rounds grow with the logarithm of the largest component. A node with very many links is never gathered: its links are
    only aggregated to a minimum and joined, and each round is a checkpoint.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    while True:
        links = checkpointed(links)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == state:
            break
        state = now
        links = _star(links)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
