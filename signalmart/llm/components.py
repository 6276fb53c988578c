"""Connected components by alternating large and small stars, staged in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.llm import common


def _star(edges: DataFrame) -> DataFrame:
    """Link every neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return edges.join(least, "a")


def connected(edges: DataFrame) -> DataFrame:
    """`node, root` from links `(a, b)` of longs: every linked node with the smallest it reaches.

    Each round is two shuffles of links, pre-aggregated per node; O(log n) rounds.
    """
    links = common.staged(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _star(large)
        next_links = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        links = common.staged(next_links.where("a <> b").distinct(), "links")
        # Links only ever move to smaller ends, so equal sums mean that nothing moved.
        now = links.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
