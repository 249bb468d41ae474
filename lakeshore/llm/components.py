"""Connected components of a link table, by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Large star (``both_ways``): every larger neighbour of a node is linked to the smallest node around
    it. Small star: a node's smaller neighbours, and itself, are linked to the smallest of them."""
    e = edges.where("a <> b")
    if both_ways:
        e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        out = e.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        linked = down.join(low, "a")
        out = (linked.select(F.col("b").alias("a"), F.col("low").alias("b"))
               .unionByName(low.select("a", F.col("low").alias("b"))))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node with a link; the root is the smallest node of its component.
    Minima are partial before each shuffle, joins split at hot nodes, and every round is a stored
    table, so neither plan nor lineage grows. Ends when a round changes nothing."""
    spark = links.sparkSession
    edges = materialize(spark, links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while True:
        edges = materialize(spark, _stars(_stars(edges, True), False), "stars")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(state) == before:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = tuple(state)
