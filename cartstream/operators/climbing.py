"""Counts that depend on themselves, over groups of any size.

Along the order of a group a row raises the count when the count so far is at most
the row's limit: a loop, on the face of it. But what a run of rows does to the count
that enters it is a function of one kind,

    F(x) = x + number of thresholds >= x

with one threshold per row, and a run followed by another is such a function again:
the thresholds b of the second become F^-1(b), the largest x with F(x) <= b. Nothing in
it depends on where runs are cut, so slices of a group are summarised in parallel, put
together in pairs, in as many rounds as the slices have doublings, and then told the count
that enters them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartstream.operators.ordered import running_sum
from cartstream.session import cut_lineage


def then(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sorted thresholds of runs followed by others; the last axes hold sorted thresholds, equally many."""
    m = first.shape[-1]
    # F(a + 1) for each threshold a of the first run; equal ones take the value of the last of them.
    beyond = first + (m - np.arange(m))
    beyond = np.minimum.accumulate(beyond[..., ::-1], axis=-1)[..., ::-1]
    from_first = np.argsort(np.concatenate([beyond, second], axis=-1), axis=-1, kind="stable") < m
    passed = np.cumsum(from_first, axis=-1)[~from_first].reshape(second.shape)
    return np.sort(np.concatenate([first, second - (m - passed)], axis=-1), axis=-1, kind="stable")


def _levels(limits: np.ndarray) -> list[np.ndarray]:
    """Thresholds of all runs of 1, 2, 4… rows; `limits` has a row per group and 2^k columns."""
    levels = [limits[:, :, None]]
    while levels[-1].shape[1] > 1:
        levels.append(then(levels[-1][:, 0::2], levels[-1][:, 1::2]))
    return levels


def _padded(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, inside): a row of `width` positions per part."""
    along = np.arange(width)
    return np.minimum(starts[:, None] + along, len(values) - 1), along < sizes[:, None]


def raised(limits: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Which rows raise their group's count, given the counts that enter; -1 fills up a group."""
    count = entry[:, None]
    for level in reversed(_levels(limits)[:-1]):
        left = level[:, 0::2]
        right = count + (left >= count[:, :, None]).sum(axis=-1)
        count = np.stack([count, right], axis=-1).reshape(len(limits), -1)
    return limits >= count


def _width(size: np.ndarray) -> np.ndarray:
    return np.left_shift(1, np.ceil(np.log2(size)).astype(np.int64))


def _thresholds(pdf: pd.DataFrame) -> pd.DataFrame:
    """(_g, _node, _v, _m): thresholds of one slice of a group with how often they occur."""
    limits = pdf.sort_values("_n")["_limit"].to_numpy(np.int64)
    limits = np.concatenate([limits, np.full(int(_width(np.array([len(limits)]))[0]) - len(limits), -1)])
    v, m = np.unique(_levels(limits[None, :])[-1].ravel(), return_counts=True)
    return pd.DataFrame({"_g": pdf["_g"].iloc[0], "_node": pdf["_node"].iloc[0], "_v": v, "_m": m})[v >= 0]


def _raise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one part after the other, in order; remembers the count of the part it is in."""
    count = 0
    for pdf in batches:
        if pdf.empty:
            continue
        limits, first = pdf["_limit"].to_numpy(np.int64), pdf["_n"].to_numpy() == 1
        begins = first.copy()
        begins[0] = True
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(starts, len(pdf)))
        entry = pdf["_entry"].to_numpy(np.int64)[starts].copy()
        if not first[0]:
            entry[0] = count
        out, widths = np.empty(len(pdf), dtype=bool), _width(sizes)
        for width in np.unique(widths):
            of = widths == width
            at, inside = _padded(limits, starts[of], sizes[of], int(width))
            out[at[inside]] = raised(np.where(inside, limits[at], -1), entry[of])[inside]
        count = int(entry[-1] + out[starts[-1]:].sum())
        yield pdf.drop(columns=["_limit", "_n", "_entry"]).assign(_raised=out)


def _pairs(level: DataFrame, slices: int) -> DataFrame:
    """One round: thresholds of nodes 2k and 2k + 1 become those of node k."""
    both = level.withColumn("_pair", F.expr("_node div 2").cast("int")).withColumn("_left", F.col("_node") % 2 == 0)
    key = ["_g", "_pair"]
    totals = both.groupBy(*key).agg(F.coalesce(F.sum(F.when(F.col("_left"), F.col("_m"))), F.lit(0)).alias("_all"))
    both = both.join(totals, key)
    left = running_sum(both.filter("_left"), key, ["_v"], "_m", "_upto", slices)
    left = left.withColumn("_at", F.col("_v") + 1 + F.col("_all") - F.col("_upto")).drop("_upto")
    right = both.filter(~F.col("_left")).withColumn("_at", F.col("_v"))
    met = left.unionByName(right).withColumn("_w", F.when(F.col("_left"), F.col("_m")).otherwise(0))
    # A left node's row comes before a right node's row at the same place.
    met = met.withColumn("_side", F.when(F.col("_left"), 0).otherwise(1))
    met = running_sum(met, key, ["_at", "_side", "_v"], "_w", "_passed", slices)
    v = F.when(F.col("_left"), F.col("_v")).otherwise(F.col("_v") - F.col("_all") + F.col("_passed"))
    moved = met.select("_g", F.col("_pair").alias("_node"), v.alias("_v"), "_m").filter("_v >= 0")
    return cut_lineage(moved.groupBy("_g", "_node", "_v").agg(F.sum("_m").alias("_m")))


def _entries(sliced: DataFrame, spread: DataFrame, keys: list[str], order: list[str], limit: str, slices: int) -> DataFrame:
    """(_k, _slice, _entry): the counts that enter the slices of the groups in `spread` (_k, _lo, _hi)."""
    span = spread.agg(F.max(F.col("_hi") - F.col("_lo"))).first()[0]
    rounds = (span or 0).bit_length()
    within = Window.partitionBy("_g", "_node").orderBy(*order)
    rows = (
        sliced.withColumn("_k", F.struct(*keys))
        .join(F.broadcast(spread), "_k")
        .select(F.col("_lo").alias("_g"), (F.col("_slice") - F.col("_lo")).alias("_node"), *order,
                F.col(limit).cast("bigint").alias("_limit"))
        .withColumn("_n", F.row_number().over(within))
        .select("_g", "_node", "_n", "_limit")
    )
    levels = []
    if rounds:
        levels.append(cut_lineage(
            rows.groupBy("_g", "_node").applyInPandas(_thresholds, "_g int, _node int, _v bigint, _m bigint")
        ))
        for _ in range(rounds - 1):
            levels.append(_pairs(levels[-1], slices))

    # Down again: a right node is entered by what its left neighbour makes of their parent's entry.
    last = spread.select(F.col("_lo").alias("_g"), (F.col("_hi") - F.col("_lo")).alias("_last"))
    entry = last.select("_g", "_last", F.lit(0).alias("_node"), F.lit(0).cast("bigint").alias("_x"))
    for r in reversed(range(rounds)):
        entered = entry.select("_g", (F.col("_node") * 2).alias("_node"), "_x", "_last")
        adds = (
            levels[r].join(F.broadcast(entered.drop("_last")), ["_g", "_node"])
            .filter(F.col("_v") >= F.col("_x")).groupBy("_g", "_node").agg(F.sum("_m").alias("_add"))
        )
        right = entered.join(adds, ["_g", "_node"], "left").select(
            "_g", "_last", (F.col("_node") + 1).alias("_node"), (F.col("_x") + F.coalesce("_add", F.lit(0))).alias("_x")
        )
        entry = cut_lineage(entered.unionByName(right).filter(F.shiftright("_last", r) >= F.col("_node")))
    return (
        entry.join(spread.select("_k", F.col("_lo").alias("_g")), "_g")
        .select("_k", (F.col("_g") + F.col("_node")).alias("_slice"), F.col("_x").alias("_entry"))
    )


def climb(
    df: DataFrame, keys: list[str], order: list[str], limit: str, out: str = "raised", slices: int | None = None
) -> DataFrame:
    """Adds `out`: does the row raise its group's count, as it does when the count so far is at most `limit`?

    Counts begin at 0; a row whose limit is negative or NULL never raises. `order` is unique within a group and not NULL.
    A group is cut into range slices; what is broadcast has a row per slice at most. The only loop
    is over rounds: none when no group is spread over slices, else the logarithm of the slices.
    """
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.repartitionByRange(n, *keys, *order).withColumn("_slice", F.spark_partition_id())
    sliced = cut_lineage(sliced.withColumn("_limit", F.coalesce(F.col(limit).cast("bigint"), F.lit(-1))))
    # Of the groups a slice holds only its lowest can have begun in an earlier slice.
    lowest = sliced.groupBy("_slice").agg(F.min(F.struct(*keys)).alias("_k")).select("_k").distinct()
    spread = cut_lineage(
        sliced.select(F.struct(*keys).alias("_k"), "_slice")
        .join(F.broadcast(lowest), "_k", "left_semi")
        .groupBy("_k").agg(F.min("_slice").alias("_lo"), F.max("_slice").alias("_hi"))
        .filter("_lo < _hi")
    )
    entries = _entries(sliced, spread, keys, order, "_limit", n)
    entries = entries.select(F.col("_slice").alias("_s"), "_entry", *[F.col("_k")[k].alias(f"_k_{k}") for k in keys])
    on = F.col("_slice") == F.col("_s")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    part = Window.partitionBy(*keys, "_slice").orderBy(*order)
    rows = (
        sliced.join(F.broadcast(entries), on, "left")
        .withColumn("_entry", F.coalesce("_entry", F.lit(0).cast("bigint")))
        .select(*df.columns, "_slice", "_limit", "_entry", F.row_number().over(part).alias("_n"))
        .sortWithinPartitions(*keys, "_slice", *order)
        .drop("_slice")
    )
    schema = df.select(*df.columns, F.lit(True).alias("_raised")).schema
    return rows.mapInPandas(_raise, schema).withColumnRenamed("_raised", out)
