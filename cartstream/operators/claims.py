"""Unique values: who may claim one, when others hold it, move on or let go.

Claims come in an order. An owner holds at most one value at a time: the one of its last claim that was granted. A claim is refused
while another owner holds the value; a refused claim changes nothing. A claim of NULL lets go and is always granted.

A claim's fate depends on earlier ones only. Claims of owners that never meet a value with several owners are granted; the others are cut
into slices of the order with about equally many claims, however often one owner or value occurs. A task settles its slice in order from
the holdings it begins with, which are those that the earlier slices ended with in the round before. That is repeated until no decision
changes: slice k is right after k rounds at the latest, mostly after two or three, and a single slice after one.
"""

from __future__ import annotations

from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartstream.operators.ordered import join_groups
from cartstream.session import cut_lineage, scratch

SLICE_ROWS = 100_000


def contending_owners(claims: DataFrame) -> DataFrame:
    """Owners in claims and holdings that meet a value which several owners ask for or hold."""
    several = (
        claims.filter(F.col("value").isNotNull()).groupBy("value").agg(F.min("owner").alias("_a"), F.max("owner").alias("_b"))
        .filter("_a <> _b").select("value")
    )
    return claims.join(several, "value", "left_semi").select("owner").distinct()


def _settle(claims: pd.DataFrame, holdings: pd.DataFrame) -> pd.DataFrame:
    """Decide one slice in order. Several owners may seem to hold a value as long as earlier slices are not settled."""
    holds, holders = {}, {}
    for owner, value in zip(holdings["owner"], holdings["value"]):
        if value is not None:
            holds[owner] = value
            holders.setdefault(value, set()).add(owner)
    claims = claims.sort_values("_n")
    granted = []
    for owner, value in zip(claims["owner"], claims["value"]):
        free = value is None or not holders.get(value, set()) - {owner}
        if free:
            if owner in holds:
                holders[holds.pop(owner)].discard(owner)
            if value is not None:
                holds[owner] = value
                holders.setdefault(value, set()).add(owner)
        granted.append(free)
    return claims[["owner", "value", "_slice", "_n"]].assign(granted=granted)


def _incoming(sliced: DataFrame, ends: DataFrame) -> DataFrame:
    """What each slice begins with, of the owners and values it names; `ends` are the values owners held at the end of slices."""
    later = F.lead("_slice").over(Window.partitionBy("owner").orderBy("_slice"))  # a row per slice and owner
    held = ends.withColumn("_until", later).select("owner", "value", F.col("_slice").alias("_since"), "_until").filter("value is not null")
    inside = "_to > _since AND (_until IS NULL OR _to <= _until)"
    named = [
        held.join(sliced.select(F.col("_slice").alias("_to"), key).distinct(), key).filter(inside)
        .select(F.col("_to").alias("_slice"), "owner", "value")
        for key in ("owner", "value")
    ]
    return named[0].unionByName(named[1]).distinct()


def grant(claims: DataFrame, held: DataFrame | None, order: list[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """`claims` (owner and value, both text, order columns, any others) with `granted`.

    `held` are the holdings before the first claim: owner, value, at most one row per owner and one per value. The order columns
    together are unique over all claims; NULL may occur in them and comes first. Claims without owner are granted and hold nothing.
    """
    live = claims.filter(F.col("owner").isNotNull())
    if held is None:
        held = live.select("owner", "value").limit(0)
    owners = cut_lineage(contending_owners(live.select("owner", "value").unionByName(held.select("owner", "value"))))
    live = live.select("owner", "value", *order).join(owners, "owner", "left_semi")
    n_slices = ceil(live.count() / slice_rows)
    if not n_slices:
        return claims.withColumn("granted", F.lit(True))
    sliced = cut_lineage(
        live.repartitionByRange(n_slices, *order).sortWithinPartitions(*order)
        .withColumn("_slice", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id())
    )
    start = held.join(owners, "owner", "left_semi").select("owner", F.lit(-1).alias("_slice"), "value")
    work, ends, before = sliced.select("owner", "value", "_slice", "_n"), start, None
    while True:
        settled = work.groupBy("_slice").cogroup(_incoming(sliced, ends).groupBy("_slice")).applyInPandas(
            _settle, "owner string, value string, _slice int, _n bigint, granted boolean")
        now = scratch(settled)
        if n_slices == 1 or before and now.df.join(before.df.withColumnRenamed("granted", "_was"), ["_slice", "_n"]).filter("granted <> _was").isEmpty():
            break
        if before:
            before.drop()
        before = now
        ended = now.df.filter("granted").groupBy("owner", "_slice").agg(F.max_by("value", "_n").alias("value"))
        ends = start.unionByName(ended)
    refused = (
        now.df.filter("not granted").select("_slice", "_n").join(sliced, ["_slice", "_n"]).select(*order, F.lit(True).alias("_refused"))
    )
    return join_groups(claims, refused, order, "left").select(*claims.columns, F.col("_refused").isNull().alias("granted"))
