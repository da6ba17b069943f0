"""Pauses of a stream of ticks, batch by batch.

Between batches only the last seconds of each key are carried: what the error window
can still reach, or, while a pause waits for its resume tick, what is needed to find
that pause again. The batch operator does the rest, so a hot key is spread over its time
blocks here too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartstream.operators.burst import pause_intervals
from cartstream.operators.metrics import MICROS, micros
from cartstream.operators.ordered import join_groups
from cartstream.streaming.jobs import COMMIT_INTERVAL, _trigger
from cartstream.streaming.state import BatchLog


class PauseTracker:
    """Follows the pauses of each key; ticks must arrive in order of time, batch by batch.

    Ticks older than the newest one of an earlier batch count as errors, but start no
    pause any more.
    """

    def __init__(
        self, spark: SparkSession, root: str, key: list[str], is_error: str, ts: str = "ts", window: int = 10,
        threshold: int = 5, cooldown: int = 5, block: int | None = None,
    ):
        self.key, self.is_error, self.ts = key, is_error, ts
        self.window, self.threshold, self.cooldown, self.block = window, threshold, cooldown, block
        self.log = BatchLog(spark, f"{root.rstrip('/')}/pauses")
        self.carry = BatchLog(spark, f"{root.rstrip('/')}/carry", newest_only=True)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        key, ts = self.key, self.ts
        errors = F.coalesce(F.col(self.is_error).cast("bigint"), F.lit(0))
        ticks = batch.groupBy(*key, ts).agg(F.sum(errors).alias("n_err"))
        before, after = self.carry.last(batch_id), None
        if before is not None:
            ticks = before.select(*key, ts, "n_err").unionByName(ticks).groupBy(*key, ts).agg(F.sum("n_err").alias("n_err"))
            after = before.groupBy(*key).agg(F.max("after_us").alias("after_us"))
        pauses = pause_intervals(
            ticks, key, "n_err", ts, self.window, self.threshold, self.cooldown, self.block, after
        )
        self.log.write(pauses, batch_id)

        # A pause without a resume tick is found again by the next batch; else all ticks are dealt with.
        written = self.log.last(batch_id + 1)
        open_pause = written.filter(F.col("resumed_tick").isNull()).groupBy(*key).agg(
            (F.max(micros(F.col("paused_at"))) - 1).alias("_open")
        )
        newest = ticks.groupBy(*key).agg(F.max(micros(F.col(ts))).alias("_newest"))
        done = join_groups(newest, open_pause, key, "left").select(
            *key, F.coalesce("_open", "_newest").alias("after_us")
        )
        reach = F.col("after_us") - self.window * MICROS
        self.carry.write(join_groups(ticks, done, key).filter(micros(F.col(ts)) >= reach), batch_id)

    def start(self, source: DataFrame, checkpoint: str, trigger: str = COMMIT_INTERVAL) -> StreamingQuery:
        writer = source.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return _trigger(writer, trigger).start()

    def read(self) -> DataFrame | None:
        """All pauses; one that was open at the end of a batch appears once, with its resume tick if known."""
        rows = self.log.read()
        if rows is None:
            return None
        return rows.groupBy(*self.key, "paused_at", "resumes_at").agg(F.max("resumed_tick").alias("resumed_tick"))
