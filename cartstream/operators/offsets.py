"""Consumed offsets as sets of intervals, one per run of offsets without a gap."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartstream.operators.ordered import join_groups

WIDTH = 1 << 16  # offsets of one stretch: what a task orders at once


def _stretch(offset, width: int):
    return F.floor(offset / width)


def islands(messages: DataFrame, keys: list[str], offset: str = "offset", width: int = WIDTH) -> DataFrame:
    """(keys…, first_offset, last_offset): the runs of consecutive offsets among `messages`; NULL offsets belong to none.

    Runs are found inside stretches of `width` offsets, so a partition with a third of all messages is many tasks, and runs that touch are
    joined afterwards.
    """
    seen = messages.filter(F.col(offset).isNotNull()).select(*keys, F.col(offset).cast("bigint").alias("_o")).distinct()
    inside = Window.partitionBy(*keys, "_stretch").orderBy("_o")
    runs = (
        seen.withColumn("_stretch", _stretch(F.col("_o"), width)).withColumn("_run", F.col("_o") - F.row_number().over(inside))
        .groupBy(*keys, "_stretch", "_run").agg(F.min("_o").alias("first_offset"), F.max("_o").alias("last_offset"))
    )
    return united(runs, keys)


def united(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, first_offset, last_offset): intervals that overlap or touch as one. A partition's intervals are ordered in one task."""
    order = Window.partitionBy(*keys).orderBy("first_offset", "last_offset")
    before = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = (before.isNull() | (F.col("first_offset") > before + 1)).cast("int")
    return (
        intervals.withColumn("_new", begins)
        .withColumn("_n", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_n").agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset")).drop("_n")
    )


def gaps(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, first_offset, last_offset, missing_after): united intervals, and how many offsets are missing up to the next one."""
    following = F.lead("first_offset").over(Window.partitionBy(*keys).orderBy("first_offset"))
    return intervals.select(*keys, "first_offset", "last_offset", (following - F.col("last_offset") - 1).alias("missing_after"))


def not_consumed(
    messages: DataFrame, intervals: DataFrame, keys: list[str], offset: str = "offset", width: int = WIDTH
) -> DataFrame:
    """The messages no interval holds; those without an offset are kept.

    Only intervals that reach into the span of these messages are looked at, cut at the ends of stretches, so the comparison is an
    equality join on (keys, stretch) with few intervals on its right.
    """
    at = F.col(offset)
    span = messages.groupBy(*keys).agg(F.min(offset).alias("_low"), F.max(offset).alias("_high"))
    near = (
        join_groups(intervals, span, keys).filter("last_offset >= _low AND first_offset <= _high")
        .select(*keys, F.greatest("first_offset", "_low").alias("_a"), F.least("last_offset", "_high").alias("_b"))
        .withColumn("_s", F.explode(F.sequence(_stretch(F.col("_a"), width), _stretch(F.col("_b"), width))))
        .select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_s", "_a", "_b")
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return messages.join(near, same & (_stretch(at, width) == F.col("_s")) & at.between(F.col("_a"), F.col("_b")), "left_anti")
