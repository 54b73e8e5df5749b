"""Connected components by alternating large-star and small-star rounds, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): the smallest node that it reaches.

    Each round is written to the shared folder, so lineage stays short. Loops and repeated edges do no
    harm; edges with a null end are left out. Rounds grow with the logarithm of the longest path.
    """
    down = stored(_larger_first(edges.where("u is not null and v is not null")).distinct(), "edges")
    seen = None
    while True:
        # Large star: each neighbour above a node moves to the least of its neighbourhood.
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _larger_first(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        # Small star: each node and its neighbours below move to the least of them.
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        down = stored(_larger_first(small).distinct(), "small-star")
        state = down.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            return down.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                down.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = state


def _larger_first(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
