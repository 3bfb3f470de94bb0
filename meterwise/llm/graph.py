"""Connected components of an edge table, by alternating star steps on Spark.

Each step links a vertex's neighbours to the smallest vertex it sees (first its
larger neighbours, then its smaller ones), which keeps the components and
flattens every one into a star around its smallest vertex. Every step is a
grouped minimum (partial aggregation takes hot vertices) and a join whose hot
side Spark can split; nothing reaches the driver but a row count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.store import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges run from the larger vertex u to the smaller vertex v.
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u").filter("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, comp)`` for every vertex of ``edges`` (columns u, v, longs) that isn't its
    component's smallest vertex; ``comp`` is that smallest vertex.

    Loops and repeated edges are allowed; an empty table gives an empty result.
    """
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = None
    while True:
        now = scratch.stage(_small_star(_large_star(now)), "star")
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen[0] == 0 or seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        state = seen
