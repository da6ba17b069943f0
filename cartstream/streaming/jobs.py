"""Streaming jobs: append to lake tables, statement sets, the webhook pipeline."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartstream import schemas
from cartstream.operators import webhooks as wh
from cartstream.operators.ingest import TOPIC_OUTPUTS
from cartstream.operators.upsert import UpsertSpec, finalize
from cartstream.session import cut_lineage
from cartstream.streaming.claims import ClaimIndex
from cartstream.streaming.state import BatchLog, KeyedState

COMMIT_INTERVAL = "60 seconds"


def _trigger(writer, trigger: str):
    return writer.trigger(availableNow=True) if trigger == "available_now" else writer.trigger(processingTime=trigger)


def append_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
    trigger: str = COMMIT_INTERVAL, name: str | None = None,
) -> StreamingQuery:
    """Exactly-once append to a Parquet table; one commit per trigger."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start(path)


def statement_set(
    source: DataFrame, outputs: dict[str, Callable[[DataFrame], DataFrame]], root: str, checkpoint: str,
    trigger: str = COMMIT_INTERVAL, name: str | None = None,
) -> StreamingQuery:
    """Several tables from one read of one source.

    The micro-batch is kept while its tables are written, each to its own batch
    folder that a re-run replaces. Read a table with `BatchLog(spark, root/table)`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for table, project in outputs.items():
                BatchLog(spark, f"{root.rstrip('/')}/{table}").write(project(kept), batch_id)
        finally:
            kept.unpersist()

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start()


def enrich_stream(
    source: DataFrame, load: Callable[[], DataFrame], enrich: Callable[[DataFrame, DataFrame], DataFrame], out: BatchLog, checkpoint: str,
    trigger: str = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Enrich a stream by a table that changes: `load` opens it anew for each micro-batch, so keys that arrive later are found.

    The rows of batch n are replaced when it runs again.
    """
    writer = source.writeStream.foreachBatch(lambda batch, batch_id: out.write(enrich(batch, load()), batch_id))
    return _trigger(writer.option("checkpointLocation", checkpoint), trigger).start()


def start_ingest(
    sources: dict[str, DataFrame], root: str, checkpoints: str, trigger: str = COMMIT_INTERVAL
) -> dict[str, StreamingQuery]:
    """One independent query per topic, each with its own checkpoint.

    A topic that feeds one table uses the exactly-once file sink; the product topic
    feeds two tables and uses a statement set. A failing query does not stop the
    others.
    """
    running = {}
    for topic, df in sources.items():
        outputs, point = TOPIC_OUTPUTS[topic], f"{checkpoints.rstrip('/')}/{topic}"
        if len(outputs) == 1:
            (table, project), = outputs.items()
            running[topic] = append_stream(
                project(df), f"{root.rstrip('/')}/{table}", point,
                schemas.LAKE_PARTITIONS.get(table), trigger, name=topic,
            )
        else:
            running[topic] = statement_set(df, outputs, root, point, trigger, name=topic)
    return running


def start_all(specs: dict[str, Callable[[], StreamingQuery]]) -> tuple[dict[str, StreamingQuery], dict[str, Exception]]:
    """Start every job; returns (running, failed to start)."""
    running, failed = {}, {}
    for name, start in specs.items():
        try:
            running[name] = start()
        except Exception as exc:  # a job that cannot start must not keep the others from starting
            failed[name] = exc
    return running, failed


class WebhookPipeline:
    """Landed webhooks to audit log, quarantine and current-state tables.

    Per micro-batch: set aside what has a bad digest, bad JSON or cannot be applied, drop bodies seen before, with `unique_values` set
    aside what claims another row's handle or e-mail address, log the rest, fold their changes into the state tables. All writes are per batch id and
    replace themselves on a re-run; the history a batch is compared with is that of
    the batches before it, so a re-run decides as the first run did.
    """

    def __init__(
        self, spark: SparkSession, root: str, secret: str | None = None, mode: str = "sha256_hex",
        specs: dict[str, UpsertSpec] | None = None, delete_policy: str = "upsert", unique_values: bool = False,
    ):
        root = root.rstrip("/")
        self.secret, self.mode, self.delete_policy = secret, mode, delete_policy
        self.specs = specs or wh.STATE_SPECS
        self.audit = BatchLog(spark, f"{root}/audit", bloom=["payload_hash"], hashed="payload_hash")
        self.rejected = BatchLog(spark, f"{root}/rejected")
        self.deletes = {t: BatchLog(spark, f"{root}/deletes/{t}") for t in ("products", "order_details", "customers")}
        self.claims = {t: ClaimIndex(spark, f"{root}/claims/{t}") for t in wh.UNIQUE if t in self.specs} if unique_values else {}
        self.states = {t: KeyedState(spark, f"{root}/state/{t}", s) for t, s in self.specs.items()}

    def changes(self, fresh: DataFrame, table: str) -> DataFrame:
        make = wh.STATE_CHANGES[table]
        return make(fresh) if table == "inventory_levels" else make(fresh, self.delete_policy)

    def _refused(self, fresh: DataFrame, batch_id: int) -> DataFrame | None:
        """(payload_hash, verdict) of requests whose unique value another row holds; what is granted is kept in the index."""
        refused = []
        for table, index in self.claims.items():
            judged = cut_lineage(index.judge(wh.unique_claims(fresh, table, self.delete_policy), batch_id))
            index.store(judged, batch_id)
            refused.append(judged.filter("not granted").select("payload_hash", F.lit(f"{wh.UNIQUE[table]} is taken").alias("verdict")))
        return reduce(DataFrame.unionByName, refused) if refused else None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        judged = wh.screened(batch, self.secret, self.mode).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            accepted = judged.filter(F.col("verdict") == "accepted").drop("verdict")
            first = wh.dedup_in_batch(accepted)
            seen = self.audit.among(first.select("payload_hash"), before=batch_id)
            fresh = first if seen is None else first.join(seen, "payload_hash", "left_anti").select(*first.columns)
            fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                refused, kept = self._refused(fresh, batch_id), fresh
                rejects = judged.filter(F.col("verdict") != "accepted")
                if refused is not None:
                    rejects = rejects.unionByName(fresh.join(refused, "payload_hash").select(*judged.columns))
                    kept = fresh.join(refused, "payload_hash", "left_anti").select(*fresh.columns)
                self.rejected.write(rejects, batch_id)
                for table, state in self.states.items():
                    state.apply(self.changes(kept, table), batch_id)
                if self.delete_policy == "tombstone":
                    for table, log in self.deletes.items():
                        log.write(wh.deleted_keys(kept, table), batch_id)
                self.audit.write(wh.to_audit(kept), batch_id)
            finally:
                fresh.unpersist()
        finally:
            judged.unpersist()

    def start(self, source: DataFrame, checkpoint: str, trigger: str = COMMIT_INTERVAL) -> StreamingQuery:
        writer = source.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return _trigger(writer, trigger).start()

    def read(self, table: str) -> DataFrame | None:
        """Current rows of a state table.

        Under 'tombstone', rows whose parent was deleted after their last update are
        left out; a deleted product takes its variants along.
        """
        state = self.states[table]
        if self.delete_policy != "tombstone" or table == "inventory_levels":
            return state.read()
        folded = state.folded()
        gone = self.deletes["products" if table == "product_variants" else table].read()
        if folded is None or gone is None:
            return state.read()
        key = {"product_variants": "product_id", "order_details": "order_id"}.get(table, "id")
        rows = finalize(folded, state.spec, arrived="_arrived")
        newest = gone.groupBy(F.col("id").alias(key)).agg(F.max("deleted_at").alias("_gone"))
        kept = rows.join(newest, key, "left").filter(
            F.col("_gone").isNull() | (F.col("_arrived.received_at") > F.col("_gone"))
        )
        return kept.select(*state.spec.key, *state.spec.columns)
