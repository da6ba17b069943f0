"""Pages at any depth of a sorted listing, by an index of exact counts.

Building sorts the rows once, by ranges of the sort key, into buckets of about `bucket_rows`, and counts each. A page then follows from the
counts: only the buckets it touches are opened, and no task keeps more than those rows, however deep the page lies. The tie-break is part
of the key, so a value that many rows share is cut into several buckets too.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from cartstream.operators.explorer import apply_filters, sort_columns

BUCKET = "_bucket"


class PageIndex:
    """A listing written to `path` in the order `page` of the explorer gives it: `rows`, in one folder per bucket, and `counts`."""

    def __init__(self, spark: SparkSession, path: str, sort_by: str | None, order: str = "desc", tiebreak: tuple[str, ...] = ("id",)):
        self.spark, self.path = spark, path.rstrip("/")
        self.sort_by, self.order, self.tiebreak = sort_by, order, list(tiebreak)

    def build(self, df: DataFrame, filters: dict | None = None, bucket_rows: int = 100_000) -> PageIndex:
        """Write the listing; sort key and tie-break together are unique."""
        rows = apply_filters(df, filters or {})
        n = max(1, ceil(rows.count() / bucket_rows))
        by = sort_columns(df, self.sort_by, self.order, self.tiebreak)
        placed = rows.repartitionByRange(n, *by).withColumn(BUCKET, F.spark_partition_id())
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/rows")
        rows.limit(0).write.mode("overwrite").parquet(f"{self.path}/schema")
        sizes = self._rows().groupBy(BUCKET).agg(F.count("*").alias("n"))
        before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one short row per bucket
        starts = sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")))
        starts.write.mode("overwrite").parquet(f"{self.path}/counts")
        return self

    def _rows(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema  # known also where no row was written
        return self.spark.read.schema(schema.add(BUCKET, IntegerType())).parquet(f"{self.path}/rows")

    @property
    def counts(self) -> DataFrame:
        """(_bucket, n, start): rows of a bucket, and rows before it."""
        return self.spark.read.schema(f"{BUCKET} int, n bigint, start bigint").parquet(f"{self.path}/counts")

    def total(self) -> int:
        return self.counts.agg(F.sum("n")).first()[0] or 0

    def page(self, number: int, limit: int = 50) -> DataFrame:
        """Page `number`, counted from 1; empty past the end."""
        first = (number - 1) * limit
        touched = self.counts.filter((F.col("start") < first + limit) & (F.col("start") + F.col("n") > first)).collect()
        rows = self._rows().filter(F.col(BUCKET).isin([r[BUCKET] for r in touched])).drop(BUCKET)
        skip = first - min((r["start"] for r in touched), default=first)
        return rows.orderBy(*sort_columns(rows, self.sort_by, self.order, self.tiebreak)).offset(skip).limit(limit)
