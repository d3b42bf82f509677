"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(d, component): for every end of an edge (a, b) the smallest node it is connected with.

    Each round joins neighbours to smaller ones until the edges are stars; the number of
    rounds grows with the logarithm of the longest path. Edges stay in tables, only their
    number and a check sum come to the driver.
    """
    now = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpointed(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = checkpointed(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("d")).distinct()
    return now.select(F.col("u").alias("d"), F.col("v").alias("component")).unionByName(
        roots.select("d", F.col("d").alias("component"))
    )
