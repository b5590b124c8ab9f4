"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(links: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), sums).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of a link; links are pairs of longs."""
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    now = stored(pairs, "links")
    before = None
    while (digest := _digest(now)) != before:
        before, last = digest, now
        now = stored(_small_star(_large_star(now)), "links")
        discard(last)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
