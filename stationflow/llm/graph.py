"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least)


def connected_components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, root`` for every node that has a link; ``root`` is its component's smallest node.

    Links are undirected; loops, repeats and nulls are ignored, and an empty table
    gives an empty result. No link and no label passes through the driver, only a
    count and a checksum for each round; rounds grow with the logarithm of the
    longest path. Each round is a staged table.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    now = staged(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not seen["n"] or (seen["n"], seen["s"]) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        mark = (seen["n"], seen["s"])
        now = staged(_small_star(_large_star(now).distinct()).distinct())
