"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import checkpointed, few, release


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return few(few(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), rows).distinct(), rows)


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    told = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return few(few(told.union(least.select("u", F.col("m").alias("v"))), rows).distinct(), rows)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (u, v): each component is called by its least node.

    Alternating large-star and small-star steps; each round's edges go to the
    checkpoint folder, and only their count and a sum of hashes reach the driver.
    A round takes as many tasks as its edges need, however many shuffle partitions there are.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = checkpointed(now)
    seen = None
    while True:
        stamp = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = few(now, stamp[0])
        if stamp == seen:
            break
        seen = stamp
        now = checkpointed(_small_star(_large_star(now, stamp[0]), stamp[0]))
        release(edges.sparkSession)
    return few(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v"), F.col("v")).distinct()), 2 * stamp[0])
