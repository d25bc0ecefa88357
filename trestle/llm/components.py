"""Connected components of a table of links, by repeated contraction.

Each round points every node at the smallest node it is linked to (or itself), follows the pointers to their roots by
doubling, and replaces the ends of all links by their roots.  At least half of the linked nodes go away each round, so
the number of rounds grows with the logarithm of the longest chain.  A round only has aggregates by node (combined on
the map side) and joins with one row per node on one side, so a node with very many links can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trestle.llm.common import land


def _roots(point: DataFrame) -> DataFrame:
    """Follow ``node -> to`` to the end; pointers only ever lead to smaller nodes."""
    while True:
        nxt = point.select(F.col("node").alias("to"), F.col("to").alias("further"))
        jumped = land(point.join(nxt, "to").select("node", F.col("further").alias("to"),
                                                   (F.col("further") != F.col("to")).alias("moved")))
        point = jumped.select("node", "to")
        if jumped.filter("moved").isEmpty():
            return point


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``, any comparable type); the root is one of its nodes."""
    def tidy(df):
        return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()

    every = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
    total = every.filter("node IS NOT NULL").distinct().select("node", F.col("node").alias("root"))
    left = land(tidy(links))
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy("a").agg(F.min("b").alias("to")).select(
            F.col("a").alias("node"), F.least("a", "to").alias("to"))
        point = _roots(point)
        step = point.select(F.col("node").alias("root"), "to")
        total = land(total.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        ends = left.join(point.select(F.col("node").alias("a"), F.col("to").alias("new_a")), "a").join(
            point.select(F.col("node").alias("b"), F.col("to").alias("new_b")), "b")
        left = land(tidy(ends.select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))))
    return total
