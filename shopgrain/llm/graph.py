"""Connected components of a large graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, label for all ends of the edges (a, b); the label is the smallest node reached.

    Every round hangs each node on the smallest neighbour that it or its neighbours know, by
    groupings and joins whose hot nodes are combined or split, and writes the result. Rounds end
    when nothing changes; their number grows with the logarithm of the size.
    """
    def minimum(links: DataFrame) -> DataFrame:
        return links.groupBy("u").agg(F.min("v").alias("m"))

    def both(links: DataFrame) -> DataFrame:
        return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def state(links: DataFrame) -> tuple:
        row = links.agg(F.count(F.lit(1)).alias("n"),
                        F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        return row["n"], row["x"]

    links = materialise(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = state(links)
    while seen[0]:
        # Large star: larger neighbours go to the smallest neighbour.
        near = both(links)
        least = minimum(near).select("u", F.least("u", "m").alias("m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: the node and its smaller neighbours go to the smallest of them.
        small = large.join(minimum(large), "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialise(
            small.unionByName(minimum(large).select("u", F.col("m").alias("v"))).distinct(), "links")
        now = state(links)
        if now == seen:
            break
        seen = now
    found = links.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct().join(
        found.select("node"), "node", "left_anti")
    return found.unionByName(roots)
