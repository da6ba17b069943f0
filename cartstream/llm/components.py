"""Connected components of a link table by alternating star steps, each of them an aggregation and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.session import Scratch, scratch


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: every node of a link and the smallest node it reaches.

    Self links and repeated or null links do no harm. Each round links every node's larger neighbours, then its smaller ones, to
    the smallest neighbour; a hot node is a skewed join key, split by adaptive execution, never one task's list. Rounds are
    cut by tables in the checkpoint folder, so a lost executor repeats one round; two numbers a round reach the driver.
    """
    edges = (
        links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .filter((F.col("u") != F.col("v")) & F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    )
    kept: Scratch = scratch(edges)
    seen = _digest(kept.df)
    while True:
        edges = kept.df
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = (
            large.join(small, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.withColumnRenamed("m", "v")).distinct()
        )
        fresh = scratch(stars)
        now = _digest(fresh.df)
        kept.drop()
        kept = fresh
        if now == seen:
            break
        seen = now
    stars = kept.df
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
