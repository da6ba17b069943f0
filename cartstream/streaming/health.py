"""Run health of streaming queries: progress as rows, and what to read off them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "job string, run_id string, batch_id bigint, started_at timestamp, input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, duration_ms bigint, "
    "commit_ms bigint, failed boolean"
)


def progress_row(p: dict, failed: bool = False) -> dict:
    """One progress report (as the engine gives it) to a row of `PROGRESS`."""
    took = p.get("durationMs") or {}
    return {
        "job": p.get("name") or p.get("id"), "run_id": p.get("runId"), "batch_id": p.get("batchId"),
        "started_at": p.get("timestamp"), "input_rows": p.get("numInputRows"),
        "input_rows_per_second": p.get("inputRowsPerSecond"),
        "processed_rows_per_second": p.get("processedRowsPerSecond"),
        "duration_ms": took.get("triggerExecution"), "commit_ms": took.get("commitOffsets"),
        "failed": failed,
    }


def progress_frame(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """The reports the engine still holds for these queries (a fixed number per query)."""
    lines = [
        json.dumps(progress_row(json.loads(p.json) if hasattr(p, "json") else dict(p)))
        for q in queries for p in q.recentProgress
    ]
    rows = spark.createDataFrame([(line,) for line in lines], "line string")
    return rows.select(F.from_json("line", PROGRESS).alias("p")).select("p.*")


class ProgressLog(StreamingQueryListener):
    """Appends each report as a JSON line through `emit` (say, a topic or a file writer)."""

    def __init__(self, emit):
        self.emit = emit
        self.names: dict[str, str] = {}  # a termination report has the id only

    def onQueryStarted(self, event):
        self.names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event):
        self.emit(json.dumps(progress_row(json.loads(event.progress.json))))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            job = self.names.get(str(event.id))
            self.emit(json.dumps(progress_row({"name": job, "id": str(event.id), "runId": str(event.runId)}, failed=True)))


class ProgressTable:
    """Keeps all reports in a table, one small file each; as `emit` of a `ProgressLog` it outlives the engine's recent reports."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __call__(self, line: str) -> None:
        rows = self.spark.createDataFrame([(line,)], "line string").coalesce(1)
        rows.select(F.from_json("line", PROGRESS).alias("p")).select("p.*").write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def query_health(progress: DataFrame) -> DataFrame:
    """(job, uptime_seconds, restarts, last_commit_ms, completed, failed, input_rows) per job.

    A new run id of the same job is a restart.
    """
    return progress.groupBy("job").agg(
        (F.max(F.unix_millis("started_at")) - F.min(F.unix_millis("started_at"))).alias("_up"),
        (F.count_distinct("run_id") - 1).alias("restarts"),
        F.max_by("commit_ms", "started_at").alias("last_commit_ms"),
        F.count_if(~F.col("failed")).alias("completed"),
        F.count_if("failed").alias("failed"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
    ).select(
        "job", (F.col("_up") / F.lit(1000)).alias("uptime_seconds"), "restarts", "last_commit_ms",
        "completed", "failed", "input_rows",
    )
