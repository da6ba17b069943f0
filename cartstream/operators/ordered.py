"""Running sums over groups of any size.

A plain ranking window sorts a whole group in one task. Here the rows are range
partitioned by (group, order), so a hot group spreads over many slices; each slice
is summed on its own and shifted by the total of the group's earlier slices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartstream.session import cut_lineage


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on group keys where NULL is a group like any other."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


HOT_ROWS = 100_000


def hot_groups(df: DataFrame, keys: list[str], rows: int = HOT_ROWS) -> DataFrame | None:
    """The groups of more than `rows` rows, written; None if there are none. At most one for each `rows` rows, so they can be broadcast."""
    hot = cut_lineage(df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows).select(*keys))
    return None if hot.isEmpty() else hot


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str, slices: int | None = None
) -> DataFrame:
    """Adds `out`: sum of `value` over the rows of the group up to and including this one.

    `order` must be unique within a group, it is what a hot group is split by. The
    slice numbers are fixed by a checkpoint, so a retried task cannot move rows
    between slices.

    The shifts that are broadcast are bounded by the number of slices: two
    neighbouring slices share at most one group, so at most slices - 1 (group,
    slice) pairs have an earlier slice.
    """
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.repartitionByRange(n, *keys, *order).withColumn("_slice", F.spark_partition_id())
    sliced = cut_lineage(sliced)

    # Only a slice's lowest group can have begun in an earlier slice.
    lowest = sliced.groupBy("_slice").agg(F.min(F.struct(*keys)).alias("_k"))
    shared = lowest.select("_k").distinct()
    totals = (
        sliced.select(F.struct(*keys).alias("_k"), "_slice", value)
        .join(F.broadcast(shared), "_k", "left_semi")
        .groupBy("_k", "_slice").agg(F.sum(value).alias("_t"))
    )
    earlier = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        totals.select("_k", "_slice", F.sum("_t").over(earlier).alias("_shift"))
        .filter(F.col("_shift").isNotNull())
        .select("_slice", *[F.col("_k")[k].alias(f"_k_{k}") for k in keys], "_shift")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    within = (
        Window.partitionBy("_s", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    on = F.col("_s") == F.col("_slice")
    for c in same:
        on = on & c
    return (
        sliced.withColumnRenamed("_slice", "_s")
        .withColumn(out, F.sum(value).over(within))
        .join(F.broadcast(shifts), on, "left")
        .withColumn(out, F.col(out) + F.coalesce(F.col("_shift"), F.lit(0)))
        .select(*df.columns, out)
    )


def row_numbers(
    df: DataFrame, keys: list[str], order: list[str], out: str = "rn", slices: int | None = None
) -> DataFrame:
    """Adds `out`: 1, 2, 3… within each group, groups of any size."""
    return running_sum(df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, "_one", out, slices).drop("_one")
