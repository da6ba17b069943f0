"""Framed messages: 0x00, a 4-byte big-endian schema id, then the encoded body."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_frame(df: DataFrame, value: str = "value", on_bad: str = "fail") -> DataFrame:
    """Adds `schema_id` and `body`.

    A frame with another first byte, or shorter than its header, is bad. on_bad:
    'fail' raises, 'quarantine' keeps the row with `frame_ok` false and NULL parts.
    """
    v = F.col(value)
    ok = (F.substring(v, 1, 1) == F.unhex(F.lit("00"))) & (F.octet_length(v) >= 5)
    ok = F.coalesce(ok, F.lit(False))
    schema_id = F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("bigint")
    body = F.substr(v, F.lit(6))
    if on_bad == "fail":
        # The check guards the value itself, so no pruning can drop it.
        checked = F.when(ok, schema_id).otherwise(
            F.raise_error(F.lit("bad frame: first byte is not 0 or header is short")).cast("bigint")
        )
        return df.withColumn("schema_id", checked).withColumn("body", F.when(ok, body))
    if on_bad == "quarantine":
        return (
            df.withColumn("frame_ok", ok)
            .withColumn("schema_id", F.when(ok, schema_id))
            .withColumn("body", F.when(ok, body))
        )
    raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")


def attach_schema(df: DataFrame, registry: DataFrame, on_unknown: str = "fail") -> DataFrame:
    """Adds the registered schema text by `schema_id`.

    registry(schema_id, schema_json) holds one row per registered schema version. It is broadcast:
    most messages of a topic carry one id, and dealt out by it they would all meet in one task.
    on_unknown: 'fail' raises for an id that is not registered, 'null' keeps the row.
    """
    known = registry.select("schema_id", "schema_json")
    out = df.join(F.broadcast(known), "schema_id", "left")
    if on_unknown == "null":
        return out
    missing = F.raise_error(F.concat(F.lit("unknown schema id "), F.col("schema_id").cast("string")))
    return out.withColumn(
        "schema_json", F.coalesce(F.col("schema_json"), missing.cast("string"))
    )


def unknown_schemas(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Schema ids in use that are not registered, with their row counts."""
    used = df.groupBy("schema_id").agg(F.count("*").alias("n_rows"))
    return used.join(registry.select("schema_id"), "schema_id", "left_anti")


def decode_avro(df: DataFrame, schemas_by_id: dict[int, str], out: str = "record") -> DataFrame:
    """Decode `body` with the schema its writer used.

    Needs Spark's Avro module on the class path. One branch per schema id; all
    schemas of one call must give the same record type, so pass the versions of one
    subject and let the first one's type lead.
    """
    from pyspark.sql.avro.functions import from_avro

    branches = None
    for schema_id, text in schemas_by_id.items():
        record = from_avro(F.col("body"), text, {"mode": "FAILFAST"})
        hit = F.col("schema_id") == F.lit(schema_id)
        branches = F.when(hit, record) if branches is None else branches.when(hit, record)
    if branches is None:
        raise ValueError("no schemas given")
    return df.withColumn(out, branches)


def decode_topic(records: DataFrame, schemas_by_id: dict[int, str], on_bad: str = "fail") -> DataFrame:
    """Broker records to typed rows: frame split, decoding, fields next to the envelope."""
    framed = split_frame(records, "value", on_bad)
    rows = decode_avro(framed, schemas_by_id, "record")
    envelope = [c for c in ("topic", "partition", "offset", "key", "timestamp") if c in records.columns]
    return rows.select(*envelope, "record.*")
