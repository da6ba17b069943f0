"""Event topics, landed webhooks and metric samples as (streaming) frames."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartstream import schemas

STARTUPS = ("committed", "latest", "earliest")


def kafka_options(topic: str, servers: str, startup: str, group_id: str | None = None) -> dict[str, str]:
    """Options of the Kafka source. Committed positions live in the query's checkpoint:
    the startup mode only decides where a query without a checkpoint begins."""
    if startup not in STARTUPS:
        raise ValueError(f"startup must be one of {STARTUPS}, not {startup!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest" if startup == "latest" else "earliest",
    }
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def read_topic(
    spark: SparkSession, topic: str, path: str | None = None, schema: T.StructType | None = None,
    source: str = "files", fmt: str = "json", startup: str = "committed", streaming: bool = True,
    max_files_per_trigger: int | None = None, servers: str | None = None, group_id: str | None = None,
    since: datetime | None = None,
) -> DataFrame:
    """One topic with its declared schema.

    source 'files' reads `<path>/<topic>`, with 'latest' only files that came at or after `since`, in order of arrival; 'kafka' gives the raw records of the
    topic (decode with `sources.wire`), for which Spark's Kafka package must be
    on the class path.
    """
    if startup not in STARTUPS:
        raise ValueError(f"startup must be one of {STARTUPS}, not {startup!r}")
    reader = spark.readStream if streaming else spark.read
    if source == "kafka":
        reader = reader.format("kafka").options(**kafka_options(topic, servers, startup, group_id))
        return reader.load()
    if source != "files":
        raise ValueError(f"source must be 'files' or 'kafka', not {source!r}")
    reader = reader.schema(schema or schemas.TOPIC_SCHEMAS[topic]).format(fmt)
    if streaming:
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.load(f"{path.rstrip('/')}/{topic}")
    if startup != "latest":
        return rows
    if since is None:
        raise ValueError("'latest' on files needs `since`: the moment of the first start, the same on every restart")
    begin = F.lit(since.astimezone(UTC).isoformat(sep=" ")).cast("timestamp")
    return rows.filter(F.col("_metadata.file_modification_time") >= begin)


def with_header_defaults(df: DataFrame) -> DataFrame:
    """Landed requests with missing headers filled in."""
    filled = {"webhook_id": "unknown", "topic": "unknown", "digest": "", "shop": ""}
    return df.select(
        *[F.coalesce(F.col(c), F.lit(filled[c])).alias(c) if c in filled else F.col(c) for c in df.columns]
    )


def read_webhooks(
    spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Landed webhook requests, one JSON object per line: headers and the body as text."""
    reader = (spark.readStream if streaming else spark.read).schema(schemas.LANDED_WEBHOOK)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_header_defaults(reader.json(path))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Metric samples: (ts, metric, labels, value)."""
    return spark.read.schema(schemas.SAMPLES).parquet(path)
