"""Session settings the operators rely on, and lineage cutting."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Runtime settings only; executor sizing and shuffle width belong to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where the split costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; returns the same session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by `spark.checkpoint.dir`.

    Without the setting a temporary folder stands in, but only on a local master: on a cluster
    every executor would write to a disk of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="cartstream-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Scratch:
    """A written intermediate table: `df` reads it, `drop` removes it once its readers are done."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path = spark, path
        self.df = spark.read.schema(schema).parquet(path)

    def drop(self) -> None:
        _delete(self.spark, self.path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SWEPT: set[str] = set()


def _scratch_root(spark: SparkSession) -> str:
    """One folder per application; removed when the driver's Python ends before its session does."""
    root = f"{checkpoint_dir(spark)}/cartstream/{spark.sparkContext.applicationId}"
    if root not in _SWEPT:
        _SWEPT.add(root)
        atexit.register(_sweep, spark, root)
    return root


def _sweep(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is not None:
        _delete(spark, root)


def scratch(df: DataFrame, compression: str | None = None) -> Scratch:
    """Write `df` as a table into the shared checkpoint folder; the caller drops it.

    A written table survives lost executors and fixes values such as partition ids
    once and for all. It is columnar, so whoever reads it back reads only the columns
    it needs.
    """
    spark = df.sparkSession
    path = f"{_scratch_root(spark)}/{uuid.uuid4()}"
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return Scratch(spark, path, df.schema)


OPEN_FILES = 8


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = OPEN_FILES) -> Iterator[None]:
    """While it holds, a task keeps up to `files` files of partition values open; only beyond these it sorts its rows by them first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """As `scratch`, for results whose reader is not known here; the table stays until the application ends."""
    return scratch(df, compression).df
