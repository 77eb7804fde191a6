"""Connected components of a large edge table by alternating large and small stars.

Each round replaces edges so that every node points closer to the smallest node of its component; the number of rounds is
about the logarithm of the longest path. Minima are combined before the shuffle, and rows meet them in joins that Spark
can split, so a node with very many edges is no obstacle. Every round is written to shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import materialise

MAX_ROUNDS = 60


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (
        down.join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
    )


def components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``node, component`` for every node of ``edges(a long, b long)``; the component is its smallest node."""
    current = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        current = materialise(small_star(large_star(current)).filter("a <> b").distinct(), "stars")
        new = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")).first()
        if new == mark:
            pairs = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return pairs.unionByName(pairs.select(F.col("component").alias("node"), "component").distinct())
        mark = new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
