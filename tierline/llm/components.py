"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(node, root)``, root the least node of the component; nodes
    without a link do not appear.

    Every round ends in a written table; rounds stop when the links no longer change, which
    takes a number in the order of the logarithm of the largest component.  A node with very
    many links is one key of a join whose partitions AQE can split, and its least neighbour
    comes from a pre-aggregated minimum.
    """
    edges = written(edges.filter("a <> b").distinct(), "links")
    mark = None
    while True:
        edges = written(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = now
