"""Connected components of links between ids, by alternating large and small stars, and joins with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, within, written

#: Rows of a narrow table (ids and numbers, up to about 40 bytes each) that a join broadcasts at most; beyond, it shuffles.
BROADCAST_ROWS = 300_000


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join with a written narrow table: broadcast if its count allows, else by shuffle, where skewed keys are split."""
    return big.join(F.broadcast(small) if within(small, BROADCAST_ROWS) else small, on, how)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and component (its smallest node) for every node of edges (a, b: long). Nodes without an edge are not listed."""
    spark = edges.sparkSession
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = _sum(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(join_small(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least2 = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = join_small(large, least2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new = written(small.unionByName(least2.withColumnRenamed("m", "v")).distinct(), "edges")
        for x in (e, least, large, least2):
            remove(spark, x.rostrum_path)
        e, now = new, _sum(new)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _sum(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s
