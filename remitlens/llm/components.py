"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    joined = both.join(least, F.col("u") == F.col("k")).withColumn("m", F.least("m", "u"))
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    joined = down.join(least, F.col("u") == F.col("k"))
    moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(joined.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it reaches) of every node that is larger than its root.

    ``edges``: u, v of type long. Each round is written to the shared folder; rounds grow with the logarithm of the
    longest path. Nodes without an edge, and roots, are not listed.
    """
    edges = settle(edges.select("u", "v").where("u <> v"), "edges")
    state = None
    while True:
        edges = settle(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(now)
