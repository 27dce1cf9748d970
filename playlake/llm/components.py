"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum (combined on the map side) and a join, so a node with very
many neighbours is spread over the tasks; AQE splits a skewed join. The number of rounds
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(low.withColumnRenamed("a", "u"), F.col("a") == F.col("u"))
    moved = linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (a, b); component is its smallest node.

    Loops, repeated edges and either direction are allowed. Nodes without an edge to
    another node are not returned.
    """
    state = store(
        spark,
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    while True:
        stats = state.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")
        ).first()
        if stats == seen or not stats["n"]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = stats
        state = store(spark, _small_star(_large_star(state)), "edges")
