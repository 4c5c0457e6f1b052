"""Connected components by alternating large-star and small-star steps; nothing is gathered on one task or the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.frames import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge that isn't the smallest itself.

    Each step needs one minimum per node (combined before the shuffle) and one join back; the number of steps
    grows with the logarithm of the longest chain. Self-loops and repeated edges are harmless.
    """
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "edges")
    signature = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == signature:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        signature = tuple(seen)
