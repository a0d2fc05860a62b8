"""Connected components over a table of links, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable


def components(links: DataFrame) -> DataFrame:
    """``<node, root>`` of ``<a, b>``: the smallest node reachable, for every node that has a link.

    Links are rewritten until each points from a node to its root: every node's neighbours, itself included, are
    linked to the smallest of them (larger neighbours first, smaller ones in the second half-step). Both half-steps
    are one aggregation and one join on the node; the number of links never grows, and rounds grow with the
    logarithm of the longest chain. Each round is a written table.
    """
    current = durable(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        # Large-star: a node's larger neighbours go to the smallest of its neighbourhood.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small-star: a node and its smaller neighbours go to the smallest of them.
        large = durable(large.distinct(), "large")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = durable(moved.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "links")
        # Links only ever point lower; when none has, every node points to its root.
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
