"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a join and an aggregation over the edges, so no component is ever
gathered in one place: a hub's edges meet its minimum in an equi-join whose
large side AQE can split.  Each round is written to the shared checkpoint
folder, which cuts the lineage and lets lost executors recompute one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import stage_table

MAX_ROUNDS = 100


def _large_star(spark: SparkSession, edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(spark: SparkSession, edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
    return row[0], row[1]


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges`` has two non-null columns of one type.  Returns ``(node, component)``,
    one row for every node of an edge between two different nodes, where
    ``component`` is the smallest node reachable.  No edges: no rows."""
    a, b = edges.columns[:2]
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    e = stage_table(spark, e.distinct(), "components")
    seen = _fingerprint(e)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        e = stage_table(spark, _small_star(spark, _large_star(spark, e)), "components")
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    centers = e.select(F.col("v").alias("node")).distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(centers.select("node", F.col("node").alias("component"))))
