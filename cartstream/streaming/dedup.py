"""Event deduplication by id, for batches and streams. Rows without an id are all kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_events(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row per id of a batch; combines before the shuffle. NULL ids pass around it."""
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    one = df.filter(F.col(key).isNotNull()).groupBy(key).agg(first)
    rows = one.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in df.columns])
    return rows.unionByName(df.filter(F.col(key).isNull()))


def dedup_stream(df: DataFrame, key: str, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Streaming form: one row per id within the watermark; the state is bounded by `delay`.

    Rows without an id pass around the state, so none is lost and none is kept there, however late. A row with an id that is later
    than the watermark may be a repetition that is no longer known: it is left out here, and `late_rows` in a
    batch function tells which. The event time is cast, because a watermark needs an instant.
    """
    named = df.filter(F.col(key).isNotNull()).withColumn("_ts", F.col(ts).cast("timestamp"))
    once = named.withWatermark("_ts", delay).dropDuplicatesWithinWatermark([key]).select(*df.columns)
    return once.unionByName(df.filter(F.col(key).isNull()))


def late_rows(batch: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Rows with an id of a batch whose id neither is among `kept` (all that the deduplication let through): for a side table."""
    return batch.filter(F.col(key).isNotNull()).join(kept.select(key).distinct(), key, "left_anti")
