"""Framed messages to typed rows, with rejects and a guard against replays: ingest of any topic, and the stand-alone consumer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartstream import schemas
from cartstream.functions import money
from cartstream.operators.ingest import TOPIC_OUTPUTS, to_consumed_order_details
from cartstream.operators.offsets import islands, not_consumed, united
from cartstream.operators.quality import ORDER_DETAIL_BOOLEANS, ORDER_DETAIL_REQUIRED, rejection_reasons
from cartstream.sinks.writers import insertable
from cartstream.sources.tables import evolve
from cartstream.sources.wire import attach_schema, split_frame
from cartstream.streaming.jobs import COMMIT_INTERVAL, _trigger
from cartstream.streaming.state import BatchLog

MESSAGE_KEY = ("topic", "partition", "offset")
PARTITION = ["topic", "partition"]


def json_record(schema: T.StructType) -> Callable[[Column], Column]:
    """Decoder of JSON bodies; NULL for a body that is not a JSON object of the schema."""
    return lambda body: F.when(
        F.try_parse_json(body.cast("string")).isNotNull(), F.from_json(body.cast("string"), schema)
    )


def _not_a_time(c: str) -> Column:
    return F.when(F.col(c).isNotNull() & F.try_to_timestamp(F.col(c)).isNull(), F.lit(f"{c} is not a time"))


def _not_money(c: Column, name: str) -> Column:
    return F.when(c.isNotNull() & money(c, "null").isNull(), F.lit(f"{name} is not an amount"))


def decoded(messages: DataFrame, registry: DataFrame, decode: Callable[[Column], Column], schema: T.StructType) -> DataFrame:
    """Envelope, the fields of `schema`, and `_broken`: why a message has none, NULL if it has.

    Fields the writer's schema lacks are NULL. A body is decoded once, however many fields are tested: the row comes out of
    an explode, which no filter on the fields is moved across, else each test would decode the body for itself.
    """
    framed = attach_schema(split_frame(messages, "value", "quarantine"), registry, on_unknown="null")
    record = F.when(F.col("schema_json").isNotNull(), decode(F.col("body")))
    records = framed.select("*", F.explode(F.array(record)).alias("record"))
    broken = (
        F.when(~F.col("frame_ok"), "bad frame").when(F.col("schema_json").isNull(), "unknown schema")
        .when(F.col("record").isNull(), "undecodable body")
    )
    envelope = [c for c in messages.columns if c != "value"]
    return evolve(records.withColumn("_broken", broken).select(*envelope, "_broken", "record.*"), schema)


def _with_reasons(rows: DataFrame, failed: Column) -> DataFrame:
    reasons = F.when(F.col("_broken").isNotNull(), F.array("_broken")).otherwise(failed)
    return rows.withColumn("reasons", reasons).drop("_broken")


def judged_topic(
    topic: str, messages: DataFrame, registry: DataFrame, decode: Callable[[Column], Column], schema: T.StructType | None = None
) -> DataFrame:
    """Messages of one of the four topics in its declared schema, with `reasons` why one cannot be ingested.

    Besides broken messages these are amounts that are none, which the lake tables would otherwise fail on.
    """
    rows = decoded(messages, registry, decode, schema or schemas.TOPIC_SCHEMAS[topic])
    tests = []
    if topic == "order_details":
        tests = [_not_money(F.col(c), c) for c in ("price", "total_discount")]
    if topic == "products":
        bad = lambda c: F.exists("variants", lambda v: _not_money(v[c], c).isNotNull())
        tests = [F.when(bad(c), F.lit(f"a variant's {c} is not an amount")) for c in ("price", "compare_at_price")]
    failed = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    return _with_reasons(rows, failed)


def judged(messages: DataFrame, registry: DataFrame, decode: Callable[[Column], Column], schema: T.StructType) -> DataFrame:
    """Envelope, the fields of `schema`, and `reasons`: why the message cannot be stored, empty if it can.

    A message has a bad frame, or an unknown schema id, or an undecodable body, or else every field that fails.
    """
    rows = decoded(messages, registry, decode, schema)
    # The payload's id is stored under another name.
    required = ["id" if c == "line_item_id" else c for c in ORDER_DETAIL_REQUIRED]
    failed = F.concat(
        rejection_reasons(required, ORDER_DETAIL_BOOLEANS, rows.schema),
        F.array_compact(F.array(*[_not_a_time(c) for c in ("created_at", "updated_at")])),
    )
    return _with_reasons(rows, failed)


def accepted(rows: DataFrame) -> DataFrame:
    """The judged rows that can be stored, in their stored form."""
    return to_consumed_order_details(rows.filter(F.size("reasons") == 0))


def rejected(rows: DataFrame) -> DataFrame:
    """(envelope…, reasons) of the others."""
    return rows.filter(F.size("reasons") > 0).select(*[c for c in MESSAGE_KEY if c in rows.columns], "reasons")


def verdicts(rows: DataFrame) -> DataFrame:
    """(envelope…, verdict) of all judged rows in one pass: 'stored', or the reasons why not."""
    why = F.array_join("reasons", "; ")
    return rows.select(*[c for c in MESSAGE_KEY if c in rows.columns], F.when(F.size("reasons") == 0, F.lit("stored")).otherwise(why).alias("verdict"))


class MessageJob:
    """Stores what the messages of a stream hold once each, and the messages that cannot be stored with their reasons.

    Tables are written per batch id and replace themselves on a re-run. A message is known by topic, partition and
    offset. What earlier batches consumed is kept as intervals of offsets, so a replay is recognised without reading
    what was stored; rejected messages are not stored again either.
    """

    tables: dict[str, Callable[[DataFrame], DataFrame]]

    def __init__(self, spark: SparkSession, root: str, registry: DataFrame, decode: Callable[[Column], Column], schema: T.StructType):
        self.registry, self.decode, self.schema = registry, decode, schema
        log = lambda name: BatchLog(spark, f"{root.rstrip('/')}/{name}")
        self.logs = {name: log(name) for name in self.tables}
        self.rejects, self.consumed = log("rejects"), log("consumed")

    def judge(self, batch: DataFrame) -> DataFrame:
        raise NotImplementedError

    def process(self, batch: DataFrame, batch_id: int) -> None:
        rows = self.judge(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            known = self.consumed.read(before=batch_id)
            new = rows if known is None else not_consumed(rows, united(known, PARTITION), PARTITION)
            for name, stored in self.tables.items():
                self.logs[name].write(stored(new), batch_id)
            self.rejects.write(rejected(new), batch_id)
            self.consumed.write(islands(rows, PARTITION), batch_id)
        finally:
            rows.unpersist()

    def start(self, source: DataFrame, checkpoint: str, trigger: str = COMMIT_INTERVAL) -> StreamingQuery:
        writer = source.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return _trigger(writer, trigger).start()


class OrderDetailConsumer(MessageJob):
    """The valid order lines, with their envelope."""

    tables = {"order_details": lambda rows: insertable(accepted(rows), None, list(MESSAGE_KEY), ["consumed_at"], "skip")}

    @property
    def stored(self) -> BatchLog:
        return self.logs["order_details"]

    def judge(self, batch: DataFrame) -> DataFrame:
        return judged(batch, self.registry, self.decode, self.schema)


def ingested(topic: str, rows: DataFrame) -> dict[str, DataFrame]:
    """Lake table to its rows, of the judged messages that can be ingested."""
    good = rows.filter(F.size("reasons") == 0)
    return {name: project(good) for name, project in TOPIC_OUTPUTS[topic].items()}


class TopicIngest(MessageJob):
    """A topic's framed messages to its lake tables: split, decoded, evolved to the declared schema and projected.

    Products feed two tables, products and variants. `schema` may name a later generation of the topic.
    """

    def __init__(
        self, spark: SparkSession, root: str, topic: str, registry: DataFrame, decode: Callable[[Column], Column],
        schema: T.StructType | None = None,
    ):
        self.topic = topic
        # A message that a batch holds twice is told by its place in the topic.
        once = lambda rows: rows.dropDuplicates(list(MESSAGE_KEY))
        self.tables = {name: lambda rows, name=name: ingested(topic, once(rows))[name] for name in TOPIC_OUTPUTS[topic]}
        super().__init__(spark, root, registry, decode, schema or schemas.TOPIC_SCHEMAS[topic])

    def judge(self, batch: DataFrame) -> DataFrame:
        return judged_topic(self.topic, batch, self.registry, self.decode, self.schema)

    def read(self, table: str) -> DataFrame | None:
        return self.logs[table].read()
