"""Connected components of a link table, by alternating star contraction.

Large-star links every larger neighbour of a node to the smallest node it
knows; small-star does the same for the smaller ones. Repeated, each
component becomes a star around its smallest node, in about log2(n) rounds.
Each half is one aggregation (a minimum, combined on the map side) and one
join that AQE can split, so a hub with very many links is not one task.
Nothing is collected: only two sums per round come to the driver, to see
whether anything changed. Rounds are written to the shared folder, so lost
executors cost a round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize


def _large_star(spark: SparkSession, edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = materialize(spark, least, "star-min")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("b"), F.col("m").alias("a")).select("a", "b").distinct()


def _small_star(spark: SparkSession, edges: DataFrame) -> DataFrame:
    # Every edge has a < b: b's smaller neighbours are its a's.
    least = materialize(spark, edges.groupBy("b").agg(F.min("a").alias("m")), "star-min")
    moved = edges.join(least, "b").where("a <> m").select(F.col("m").alias("x"), F.col("a").alias("y"))
    kept = least.select(F.col("m").alias("x"), F.col("b").alias("y"))
    return moved.union(kept).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node of its component. Self links are ignored. No links, no rows."""
    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    now = materialize(spark, now, "links")
    seen = None
    while True:
        total = now.agg(F.count("a").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not total.n or (total.n, total.s) == seen:
            break
        seen = (total.n, total.s)
        now = materialize(spark, _small_star(spark, _large_star(spark, now)), "links")
    members = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return members.union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
