"""Batch and per-micro-batch writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream import schemas


def message_key(df: DataFrame, key: str):
    return F.col(key).cast("string")


def to_messages(df: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """(topic, key, value): the key as decimal text, the row as JSON."""
    key = key or schemas.TOPIC_KEYS[topic]
    return df.select(
        F.lit(topic).alias("topic"), message_key(df, key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value")
    )


def publish_kafka(df: DataFrame, topic: str, servers: str, key: str | None = None) -> None:
    """Send rows to a topic; the broker keeps the order of each key's partition.

    Needs Spark's Kafka package on the class path.
    """
    to_messages(df, topic, key).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def publish_files(df: DataFrame, path: str, topic: str, key: str | None = None, order: str | None = None) -> None:
    """Land rows as JSON files under `<path>/<topic>`, each file sorted by key and `order`.

    Range partitioning instead of hashing: with `order` a hot key spreads over
    neighbouring files, whose names keep its order.
    """
    key = key or schemas.TOPIC_KEYS[topic]
    by = [key] + ([order] if order else [])
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    rows.write.mode("append").json(f"{path.rstrip('/')}/{topic}")


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows to a Parquet table, written near the target file size.

    `REBALANCE` lets adaptive execution merge small and split big partition
    values, so a location that holds a third of all rows is written by many tasks.
    """
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    writer = rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def key_conflicts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once in the batch."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def insertable(
    df: DataFrame, target: DataFrame | None, keys: list[str], order: list[str], on_conflict: str = "fail"
) -> DataFrame:
    """The rows of `df` that may be inserted into `target`, unique by `keys`.

    on_conflict 'skip' keeps the first row of each new key (by `order`); 'fail'
    raises while the rows are read if a key is taken or repeated.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    one = df.groupBy(*keys).agg(first, F.count("*").alias("_n"))
    if target is None:
        flagged = one.withColumn("_taken", F.lit(None).cast("boolean"))
    else:
        # Only the history's keys that this batch touches take part.
        taken = target.select(*keys).join(one.select(*keys), keys, "left_semi").distinct()
        flagged = one.join(taken.withColumn("_taken", F.lit(True)), keys, "left")
    if on_conflict == "skip":
        kept = flagged.filter(F.col("_taken").isNull())
    elif on_conflict == "fail":
        clash = F.raise_error(
            F.concat(F.lit("duplicate key: "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))
        ).cast("boolean")
        kept = flagged.filter(F.when(F.col("_taken").isNull() & (F.col("_n") == 1), F.lit(True)).otherwise(clash))
    else:
        raise ValueError(f"on_conflict must be 'fail' or 'skip', not {on_conflict!r}")
    return kept.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def insert_unique(
    df: DataFrame, path: str, keys: list[str], order: list[str], on_conflict: str = "fail"
) -> None:
    """Append to the Parquet table at `path` under a uniqueness rule.

    With 'fail' nothing is committed when a key clashes: the job fails before the
    output is.
    """
    try:
        target = df.sparkSession.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        target = None  # no table yet
    insertable(df, target, keys, order, on_conflict).write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; NULL is empty, quotes are doubled, line breaks are quoted."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "").option(
        "emptyValue", ""
    ).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields are written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
