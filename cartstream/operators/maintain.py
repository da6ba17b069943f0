"""Table upkeep: small-file compaction and snapshot expiry."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartstream.operators.ordered import join_groups, running_sum
from cartstream.session import scratch, unsorted_writes
from cartstream.sources.folders import delete_folder, finished_folders, finished_since

TARGET_BYTES = 134_217_728
RETAIN_LAST = 5
OLDER_THAN = "1 hour"


def list_files(spark: SparkSession, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """(partition, file_path, size_bytes), one row per Parquet file of a table.

    The binary-file source lists the files; as the content column is not asked for,
    no file is opened.
    """
    parts = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in partition_by or []]
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listing.select(
        F.concat_ws("/", *parts).alias("partition"),
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size_bytes"),
    )


def plan_compaction(
    files: DataFrame, group: list[str], target: int = TARGET_BYTES, slices: int | None = None
) -> DataFrame:
    """Adds `bin`: files of a group in path order, cut where the bytes before reach a multiple of `target`.

    A bin holds less than `target` plus its last file. The running size is summed in
    slices, so one partition may hold most of the files.
    """
    summed = running_sum(files, group, ["file_path"], "size_bytes", "_upto", slices)
    return summed.withColumn(
        "bin", F.expr(f"(_upto - size_bytes) div {target}").cast("bigint")
    ).drop("_upto")


def compaction_groups(plan: DataFrame, group: list[str]) -> DataFrame:
    """(group…, bin, n_files, size_bytes); bins of one file need no rewrite."""
    return plan.groupBy(*group, "bin").agg(
        F.count("*").alias("n_files"), F.sum("size_bytes").cast("bigint").alias("size_bytes")
    )


def rewrite(
    spark: SparkSession, source: str, destination: str, partition_by: list[str] | None = None,
    target: int = TARGET_BYTES,
) -> tuple[int, int]:
    """Rewrite a Parquet table into files of about `target` bytes at a new place.

    Each bin of the compaction plan is one task's rows, whatever the values in it; they are written as they come. Returns (rows before, rows after) after checking
    that they agree; the source is left alone, the caller switches over to the new folder. `due` tells whether a
    rewrite is worth while.
    """
    plan = plan_compaction(list_files(spark, source, partition_by), ["partition"], target)
    rows = spark.read.parquet(source)
    with scratch(_numbered_bins(plan)) as numbered:
        n_bins = (numbered.df.agg(F.max("_bin")).first()[0] or 0) + 1
        placed = (
            rows.select("*", F.col("_metadata.file_path").alias("file_path"))
            .join(numbered.df, "file_path").repartitionById(n_bins, F.col("_bin")).select(*rows.columns)
        )
        writer = placed.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with unsorted_writes(spark):
            writer.parquet(destination)
    before, after = rows.count(), spark.read.parquet(destination).count()
    if before != after:
        raise RuntimeError(f"compaction of {source} lost rows: {before} before, {after} after")
    return before, after


def _numbered_bins(plan: DataFrame) -> DataFrame:
    """(file_path, _bin) with dense bin numbers; there is one bin per `target` bytes, so few are numbered in one task."""
    bins = plan.select("partition", "bin").distinct()
    number = (F.row_number().over(Window.orderBy("partition", "bin")) - 1).alias("_bin")
    return join_groups(plan, bins.select("partition", "bin", number), ["partition", "bin"]).select("file_path", "_bin")


def due(spark: SparkSession, source: str, partition_by: list[str] | None = None, target: int = TARGET_BYTES) -> bool:
    """Is there a bin of several files? A table whose bins are single files is left alone."""
    plan = plan_compaction(list_files(spark, source, partition_by), ["partition"], target)
    return not compaction_groups(plan, ["partition"]).filter("n_files > 1").isEmpty()


# -- tables kept in bins ---------------------------------------------------------

BIN = "_bin"


def bin_sizes(spark: SparkSession, root: str, partition_by: list[str]) -> DataFrame:
    """(partition_by…, _bin, n_files, size_bytes) of a table partitioned by `partition_by` and `_bin`; no file is opened."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    return listing.groupBy(*partition_by, BIN).agg(F.count("*").alias("n_files"), F.sum(F.col("_metadata.file_size")).alias("size_bytes"))


def append_to_bins(rows: DataFrame, root: str, partition_by: list[str], target: int = TARGET_BYTES) -> None:
    """Append to the open bin of each partition: its newest one, or the next when that holds `target` bytes.

    The table is plain Parquet with one more partition column, so small files gather in one folder per partition.
    """
    spark, opened = rows.sparkSession, None
    if _exists(spark, root):
        newest = bin_sizes(spark, root, partition_by).groupBy(*partition_by).agg(F.max_by("size_bytes", BIN).alias("_size"), F.max(BIN).alias("_last"))
        opened = newest.select(
            *[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in partition_by],
            (F.col("_last") + (F.col("_size") >= target).cast("int")).alias(BIN),
        )
    placed = rows.withColumn(BIN, F.lit(0)) if opened is None else (
        join_groups(rows, opened, partition_by, "left").withColumn(BIN, F.coalesce(BIN, F.lit(0)))
    )
    placed.select(*rows.columns, BIN).write.mode("append").partitionBy(*partition_by, BIN).parquet(root)


def compact_bins(spark: SparkSession, root: str, partition_by: list[str]) -> int:
    """Rewrite the bins of several files, each as one file (as several where it is larger than a task's share); how many there were.

    Their folders are replaced by a dynamic partition overwrite; the files of all other bins stay as they are. The rows come
    from a written copy of these bins alone, whose number is compared before anything is replaced.
    """
    several = bin_sizes(spark, root, partition_by).filter("n_files > 1").select(*partition_by, BIN)
    with scratch(several) as todo:
        bins = todo.df.count()
        if not bins:
            return 0
        table = spark.read.parquet(root)
        chosen = join_groups(table, todo.df, [*partition_by, BIN], "left_semi").select(*table.columns)
        with scratch(chosen.hint("rebalance", *partition_by, BIN)) as copy:
            before, after = chosen.count(), copy.df.count()
            if before != after:
                raise RuntimeError(f"compaction of {root} would change its rows: {before} before, {after} after")
            copy.df.hint("rebalance", *partition_by, BIN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *partition_by, BIN).parquet(root)
    return bins


def read_bins(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop(BIN)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def expired_snapshots(
    snapshots: DataFrame, now, older_than: str = OLDER_THAN, retain_last: int = RETAIN_LAST
) -> DataFrame:
    """Snapshots that may go: older than the limit and not among the newest `retain_last` of their table.

    The newest few per table come from a capped ranking that is evaluated before
    the shuffle as well (a rank filter is pushed into a per-task top-k), so the
    tables' full histories are not sorted in one place.
    """
    w = Window.partitionBy("table_name").orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc())
    kept = (
        snapshots.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= retain_last)
        .select("table_name", "snapshot_id")
    )
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {older_than}")
    return snapshots.filter(F.col("committed_at") < cutoff).join(
        kept, ["table_name", "snapshot_id"], "left_anti"
    )


class VersionedTable:
    """A Parquet table kept as finished versions `<root>/version=<n>`; readers take the newest.

    Compaction and replacement write the next version and never touch the one being
    read; expiry removes old versions by the snapshot rule.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by: list[str] | None = None):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), partition_by

    def _at(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def versions(self) -> list[int]:
        return finished_folders(self.spark, self.root, "version")

    def path(self) -> str:
        """Folder of the newest version."""
        ids = self.versions()
        if not ids:
            raise FileNotFoundError(f"no finished version under {self.root}")
        return self._at(ids[-1])

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path())

    def replace(self, rows: DataFrame) -> int:
        """Write `rows` as the next version."""
        new = max(self.versions(), default=0) + 1
        writer = rows.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(self._at(new))
        return new

    def compact(self, target: int = TARGET_BYTES) -> int:
        """Rewrite the newest version's files to about `target` bytes each, as the next version; not if they are already."""
        ids = self.versions()
        if not due(self.spark, self.path(), self.partition_by, target):
            return ids[-1]
        source, new = self.path(), ids[-1] + 1
        delete_folder(self.spark, self._at(new))  # left over from a run that did not finish
        rewrite(self.spark, source, self._at(new), self.partition_by, target)
        return new

    def expire(self, now=None, older_than: str = OLDER_THAN, retain_last: int = RETAIN_LAST) -> list[int]:
        """Remove versions older than the limit that are not among the newest `retain_last`."""
        done = finished_since(self.spark, self.root, "version")
        if not done:
            return []
        now = now or datetime.now(UTC).replace(tzinfo=None)
        rows = [(self.root, v, at) for v, at in done.items()]
        snapshots = self.spark.createDataFrame(rows, "table_name string, snapshot_id bigint, committed_at timestamp_ntz")
        gone = sorted(r["snapshot_id"] for r in expired_snapshots(snapshots, str(now), older_than, retain_last).collect())
        for v in gone:
            delete_folder(self.spark, self._at(v))
        return gone


def catalog_calls(catalog: str, table: str, cutoff: str, target: int = TARGET_BYTES, retain_last: int = RETAIN_LAST) -> list[str]:
    """The maintenance statements for a table of a catalog that brings its own procedures."""
    # Names and arguments of the table format's published procedures.
    return [
        f"CALL {catalog}.system.rewrite_data_files(table => '{table}', strategy => 'binpack', "
        f"options => map('target-file-size-bytes', '{target}'))",
        f"CALL {catalog}.system.rewrite_manifests(table => '{table}')",
        f"ALTER TABLE {table} SET TBLPROPERTIES ('gc.enabled' = 'true')",
        f"CALL {catalog}.system.expire_snapshots(table => '{table}', older_than => TIMESTAMP '{cutoff}', retain_last => {retain_last})",
    ]


def maintain(spark: SparkSession, steps: dict[str, list[tuple[str, Callable[[], object]]]]) -> DataFrame:
    """Run each table's steps, say {"orders": [("compact", t.compact), ("expire", t.expire)]}.

    A failing step ends that table only.

    Returns (table_name, step, ok, error, elapsed_seconds). The loop is over tables
    and steps; the work of a step is a Spark job.
    """
    rows = []
    for table, todo in steps.items():
        for name, action in todo:
            begun = time.monotonic()
            try:
                action()
            except Exception as exc:  # one table's failure must not stop the others
                rows.append((table, name, False, str(exc), time.monotonic() - begun))
                break
            rows.append((table, name, True, None, time.monotonic() - begun))
    return spark.createDataFrame(
        rows, "table_name string, step string, ok boolean, error string, elapsed_seconds double"
    )
