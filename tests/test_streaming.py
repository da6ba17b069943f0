"""Streams over files: same rows as the batch, nothing twice after a restart or a replay."""

import hashlib
import json
import os
import time
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartstream import schemas
from cartstream.operators import ingest
from cartstream.operators import metrics
from cartstream.operators import webhooks as wh
from cartstream.operators.upsert import UpsertSpec, upsert
from cartstream.plans import adapters as a
from cartstream.plans.registry import Tables
from cartstream.plans.registry import Tables
from cartstream.sources.tables import read_table
from cartstream.sources.topics import kafka_options, read_topic, read_webhooks
from cartstream.streaming import consumer, health, jobs
from cartstream.streaming.dedup import dedup_stream
from cartstream.streaming.state import BatchLog, KeyedState

T0 = datetime(2024, 1, 1)
NOW = "available_now"


def same(left, right):
    cols = right.columns
    assert sorted(left.columns) == sorted(cols)
    left = left.select(*cols)
    assert left.count() == right.count()
    assert left.exceptAll(right).count() == 0


@pytest.fixture()
def tables(spark, sf):
    return Tables(spark, sf)


def test_ingest_of_all_topics_equals_the_batch(spark, tables, tmp_path):
    land, lake, ck = str(tmp_path / "land"), str(tmp_path / "lake"), str(tmp_path / "ck")
    raws = {
        "products": a.raw_products(tables), "order_details": a.raw_order_details(tables),
        "inventory": a.raw_inventory(tables), "customers": a.raw_customers(tables),
    }
    def arrive(part):
        for topic, raw in raws.items():
            half = F.xxhash64("event_id") % 2 == 0
            raw.filter(half if part == 0 else ~half).repartition(2).write.mode("append").json(f"{land}/{topic}")

    def run():
        sources = {t: read_topic(spark, t, land, max_files_per_trigger=1) for t in raws}
        started = jobs.start_ingest(sources, lake, ck, NOW)
        for q in started.values():
            q.awaitTermination(240)
            assert q.exception() is None
        return started

    arrive(0)
    run()
    arrive(1)
    last = run()  # restart from the checkpoints: only the new files
    for topic, outputs in ingest.TOPIC_OUTPUTS.items():
        for table, project in outputs.items():
            got = read_table(spark, table, str(lake))
            same(got, project(raws[topic]))
    # Identity partitioning reads back with pruning.
    one = spark.read.parquet(f"{lake}/inventory_levels").filter("location_id = 2")
    files = one.inputFiles()
    assert one.count() > 0 and any("location_id=2/" in f for f in files)
    assert all("location_id=2/" in f for f in one.select("location_id", F.input_file_name().alias("f")).toPandas()["f"])
    report = health.query_health(health.progress_frame(spark, list(last.values()))).collect()
    assert {r["job"] for r in report} == set(raws) and all(r["failed"] == 0 for r in report)


def test_a_failing_job_does_not_stop_the_others(spark, tmp_path):
    schema = schemas.RAW_CUSTOMERS
    spark.createDataFrame([], schema).write.json(str(tmp_path / "customers"))
    spark.createDataFrame([("e", 1, "a@x", "A", "B", None, "enabled", True, "", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z")],
                          schema).write.mode("append").json(str(tmp_path / "customers"))
    good = read_topic(spark, "customers", str(tmp_path))
    bad = good.withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))
    running, failed = jobs.start_all({
        "bad": lambda: jobs.append_stream(bad, str(tmp_path / "o1"), str(tmp_path / "c1"), trigger=NOW),
        "good": lambda: jobs.append_stream(good, str(tmp_path / "o2"), str(tmp_path / "c2"), trigger=NOW),
        "unknown": lambda: read_topic(spark, "no_topic", str(tmp_path)),
    })
    assert set(failed) == {"unknown"}
    with pytest.raises(Exception):
        running["bad"].awaitTermination(120)
    running["good"].awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "o2")).count() == 1


def webhook_files(tables, path):
    every = a.order_webhooks(tables).unionByName(a.customer_webhooks(tables)).unionByName(a.product_webhooks(tables))
    every = every.unionByName(a.inventory_webhooks(tables)).withColumn("digest", F.sha2("body", 256)).withColumn("shop", F.lit("s"))
    broken = every.limit(5).withColumn("body", F.lit("{")).withColumn("digest", F.sha2(F.lit("{"), 256))
    forged = every.limit(7).withColumn("digest", F.lit("no"))
    return every, every.unionByName(broken).unionByName(forged)


def test_webhook_pipeline_state_equals_one_batch_and_replays_are_harmless(spark, tables, tmp_path):
    every, landed = webhook_files(tables, tmp_path)
    land = str(tmp_path / "land")
    # Files in arrival order, so that "first" and "seen before" mean the same in every split.
    landed.repartitionByRange(3, "received_at", "webhook_id").sortWithinPartitions("received_at", "webhook_id").write.json(land)
    pipe = jobs.WebhookPipeline(spark, str(tmp_path / "out"), secret="s")
    q = pipe.start(read_webhooks(spark, land, streaming=True, max_files_per_trigger=1), str(tmp_path / "ck"), NOW)
    q.awaitTermination(600)
    assert q.exception() is None
    deduped = wh.dedup_in_batch(every)
    want = {t: upsert(wh.STATE_CHANGES[t](deduped), s) for t, s in wh.STATE_SPECS.items()}
    for table in want:
        same(pipe.read(table), want[table])
    assert pipe.audit.read().count() == deduped.count()
    assert pipe.rejected.read().groupBy("verdict").count().count() == 2

    # A batch that is run again (killed before its offsets were committed) changes nothing.
    again = spark.read.schema(schemas.LANDED_WEBHOOK).json(land)
    first = again.filter(F.col("webhook_id").isNotNull()).orderBy("received_at", "webhook_id").limit(100)
    pipe2 = jobs.WebhookPipeline(spark, str(tmp_path / "out2"))
    for _ in range(2):
        pipe2.process(first, 0)
    n = pipe2.audit.read().count()
    pipe2.process(first, 1)  # the same bodies later: all duplicates
    assert pipe2.audit.read().count() == n

    for table, state in pipe.states.items():
        state.compact()
        same(pipe.read(table), want[table])


def test_keyed_state_compaction_keeps_what_later_batches_need(spark, tmp_path):
    spec = wh.STATE_SPECS["customers"]
    rows = lambda i, email: spark.createDataFrame(
        [(f"w{i}", "customers/update", "", "", json.dumps({"id": 1, "email": email, "state": f"s{i}"}), T0 + timedelta(days=i))],
        schemas.LANDED_WEBHOOK)
    state = KeyedState(spark, str(tmp_path / "s"), spec)
    assert state.read() is None
    for i, email in enumerate(["a@x", "", None, "b@x", ""]):
        state.apply(wh.customer_changes(rows(i, email)), i)
        if i % 2:
            state.compact()
            state.compact()
    (got,) = state.read().collect()
    assert (got["email"], got["state"], got["created_at"]) == ("b@x", "s4", T0)
    state.compact(keep=1)
    assert state.read().count() == 1


def test_tombstones(spark, tmp_path):
    def hooks(*items):
        return spark.createDataFrame(
            [(f"w{i}", topic, "", "", json.dumps(body), T0 + timedelta(days=i)) for i, (topic, body) in items], schemas.LANDED_WEBHOOK)

    pipe = jobs.WebhookPipeline(spark, str(tmp_path), delete_policy="tombstone")
    pipe.process(hooks(
        (0, ("products/create", {"id": 1, "title": "a", "variants": [{"id": 11, "price": 1}]})),
        (1, ("products/create", {"id": 2, "title": "b", "variants": [{"id": 21, "price": 1}]})),
        (2, ("orders/create", {"id": 5, "line_items": [{"id": 51, "price": 1}]}))), 0)
    pipe.process(hooks((3, ("products/delete", {"id": 1})), (4, ("orders/delete", {"id": 5})), (5, ("products/delete", {"id": 2}))), 1)
    pipe.process(hooks((6, ("products/create", {"id": 2, "title": "back"}))), 2)
    assert [r["id"] for r in pipe.read("products").collect()] == ["2"]
    assert pipe.read("product_variants").count() == 0
    assert pipe.read("order_details").count() == 0


def test_dedup_stream_keeps_null_ids(spark, tmp_path):
    rows = [(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)]
    df = spark.createDataFrame([(k, v, T0 + timedelta(seconds=v)) for k, v in rows], "k string, v int, ts timestamp_ntz")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = jobs.append_stream(dedup_stream(src, "k", "ts"), str(tmp_path / "out"), str(tmp_path / "ck"), trigger=NOW)
    q.awaitTermination(240)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["k"] or "-") for r in got.collect()) == ["-", "-", "a", "b"]


def test_dedup_stream_keeps_late_null_ids(spark, tmp_path):
    """A first batch moves the watermark; rows without an id that come hours later than it are kept, repeated ids are not."""
    schema = "k string, v int, ts timestamp_ntz"
    for n, rows in enumerate([[("a", 1, 600), (None, 2, 600)], [(None, 3, 0), ("a", 4, 600), ("b", 5, 601)]]):
        df = spark.createDataFrame([(k, v, T0 + timedelta(minutes=m)) for k, v, m in rows], schema)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        src = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        jobs.append_stream(dedup_stream(src, "k", "ts"), str(tmp_path / "out"), str(tmp_path / "ck"), trigger=NOW).awaitTermination(240)
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 5]


def test_bodies_that_cannot_be_applied_are_set_aside(spark, tmp_path):
    pipe = jobs.WebhookPipeline(spark, str(tmp_path / "p"))
    bodies = [("products/create", {"id": 1}), ("products/update", {"id": 2}), ("products/create", {"id": 3, "title": "t"}),
              ("products/update", {"id": 4, "title": "t", "updated_at": "never"})]
    rows = [(f"w{i}", topic, "", "", json.dumps(body), T0 + timedelta(days=i)) for i, (topic, body) in enumerate(bodies)]
    pipe.process(spark.createDataFrame(rows, schemas.LANDED_WEBHOOK), 0)
    assert sorted(r["verdict"] for r in pipe.rejected.read().collect()) == ["title is missing", "updated_at is not a time"]
    assert sorted(r["id"] for r in pipe.read("products").collect()) == ["2", "3"]


def test_latest_on_files_skips_what_was_there(spark, tmp_path):
    (tmp_path / "inventory").mkdir()
    write = lambda k: (tmp_path / "inventory" / f"{k}.json").write_text(json.dumps({"inventory_item_id": k}) + "\n")
    write(1)
    os.utime(tmp_path / "inventory" / "1.json", (1_700_000_000, 1_700_000_000))
    since = datetime.fromtimestamp(1_700_000_001, UTC)
    write(2)
    for streaming in (False, True):
        rows = read_topic(spark, "inventory", str(tmp_path), startup="latest", since=since, streaming=streaming)
        if streaming:
            jobs.append_stream(rows, str(tmp_path / "out"), str(tmp_path / "ck"), trigger=NOW).awaitTermination(240)
            rows = spark.read.parquet(str(tmp_path / "out"))
        assert [r["inventory_item_id"] for r in rows.collect()] == [2]
    with pytest.raises(ValueError, match="since"):
        read_topic(spark, "inventory", str(tmp_path), startup="latest")


def test_enrichment_sees_keys_that_arrive_after_the_start(spark, tmp_path):
    dim, out = str(tmp_path / "dim"), BatchLog(spark, str(tmp_path / "out"))
    add = lambda k: spark.createDataFrame([(k, f"n{k}")], "k int, name string").coalesce(1).write.mode("append").parquet(dim)
    join = lambda batch, names: batch.join(names, "k", "left")
    spark.createDataFrame([(1,), (2,)], "k int").coalesce(1).write.parquet(str(tmp_path / "in"))
    add(1)
    src = spark.readStream.schema("k int").parquet(str(tmp_path / "in"))
    run = lambda: jobs.enrich_stream(src, lambda: spark.read.parquet(dim), join, out, str(tmp_path / "ck"), NOW).awaitTermination(240)
    run()
    add(2)
    spark.createDataFrame([(2,)], "k int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted(map(tuple, out.read().collect()), key=str) == [(1, "n1"), (2, "n2"), (2, None)]


def test_logs_and_state_stay_in_few_folders(spark, tmp_path):
    log, spec = BatchLog(spark, str(tmp_path / "log"), compact_every=4), UpsertSpec(("id",), {"v": "last"}, order=("at",))
    state = KeyedState(spark, str(tmp_path / "state"), spec, compact_every=4)
    for k in range(18):
        rows = spark.createDataFrame([(k % 3, f"v{k}", k)], "id int, v string, at int").coalesce(1)
        for _ in range(2 if k in (7, 8) else 1):  # some batches run twice
            log.write(rows, k)
            state.apply(rows, k)
        assert log.last(k).first()["at"] == k - 1 if k else log.last(k) is None
        assert log.read(before=k).count() == k if k else log.read(before=k) is None
    assert sorted(r["at"] for r in log.read().collect()) == list(range(18))
    assert len([d for d in os.listdir(tmp_path / "log") if "=" in d]) <= 6
    assert sorted(map(tuple, state.read().collect())) == [(0, "v15"), (1, "v16"), (2, "v17")]
    assert len(os.listdir(tmp_path / "state" / "delta")) <= 8 and state.folded()._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_merging_rewrites_a_logarithmic_share(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path), compact_every=3)
    rewritten, combine = [], log._combine
    log._combine = lambda paths, path: (rewritten.append(sum(spark.read.parquet(p).count() for p in paths)), combine(paths, path))
    for k in range(40):
        log.write(spark.createDataFrame([(k,)], "v int").coalesce(1), k)
        if k == 26:
            reader = log.read()
        if k == 28:
            assert reader.count() == 27  # opened before a merge, finished after it
    assert sorted(r["v"] for r in log.read().collect()) == list(range(40))
    assert sum(rewritten) <= 4 * 40 and len(log.levels.live()) <= 3 * 4
    log.write(spark.createDataFrame([(99,)], "v int"), 5)  # merged long ago: it is not stored twice
    assert log.read().count() == 40


def test_the_audit_is_read_by_prefix(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path), compact_every=4, hashed="h", digits=2)
    sha = lambda k: hashlib.sha256(str(k).encode()).hexdigest()
    for k in range(14):
        log.write(spark.createDataFrame([(sha(10 * k + j), k) for j in range(10)], "h string, batch int").coalesce(1), k)
    assert sorted(r["h"] for r in log.read().collect()) == sorted(sha(k) for k in range(140))
    asked = spark.createDataFrame([(sha(k), k) for k in (3, 57, 139, 1000)], "h string, k int")
    found = log.among(asked.select("h"))
    assert sorted(r["h"] for r in found.collect()) == sorted(sha(k) for k in (3, 57, 139))
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["h"] for r in log.among(asked.select("h"), before=13).collect()) == sorted(sha(k) for k in (3, 57))


def test_consumer_stores_each_valid_message_once(spark, sf, tmp_path):
    schema = T.StructType([f for f in a.raw_order_details(Tables(spark, sf)).schema if f.name != "event_id"])
    full = {f.name: None for f in schema} | {
        "order_id": 1, "title": "t", "name": "n", "quantity": 1, "fulfillable_quantity": 1, "current_quantity": 1, "price": "1.00",
        "total_discount": "0.00", "fulfillment_service": "manual", "grams": 5, "requires_shipping": True, "taxable": True, "gift_card": False,
        "product_exists": True, "created_at": "2024-01-01T00:00:00+05:00", "updated_at": "2024-01-01T00:00:00Z"}
    body = lambda **kw: json.dumps({k: v for k, v in (full | kw).items() if v is not None}).encode()
    frame = lambda raw, head=b"\x00\x00\x00\x00\x01": head + raw
    good = [(k, frame(body(id=k))) for k in range(3)]
    bad = [(10, b"\x01\x00"), (11, frame(body(id=1), b"\x00\x00\x00\x00\x07")), (12, frame(b"{")), (13, frame(body(id=2, title="\n"))),
           (14, frame(body(id=3, created_at="yesterday"))), (15, None)]
    source = spark.createDataFrame([("t", 0, o, None, v) for o, v in [*good, *bad]], "topic string, partition int, offset bigint, key string, value binary")
    registry = spark.createDataFrame([(1, "x")], "schema_id bigint, schema_json string")
    job = consumer.OrderDetailConsumer(spark, str(tmp_path / "job"), registry, consumer.json_record(schema), schema)
    at = F.lit("2024-06-01").cast("timestamp").alias("consumed_at")

    def run():
        src = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in")).select("*", at)
        job.start(src, str(tmp_path / "ck"), NOW).awaitTermination(240)

    source.coalesce(1).write.parquet(str(tmp_path / "in"))
    run()
    source.filter("offset < 2").unionByName(source.filter("offset = 2").withColumn("offset", F.lit(20).cast("bigint"))).coalesce(1).write.mode(
        "append").parquet(str(tmp_path / "in"))  # two messages again, and a new one
    run()
    job.process(source.filter("offset < 3").select("*", at), 1)  # the last batch once more
    assert sorted(r["offset"] for r in job.stored.read().collect()) == [0, 1, 2]
    job.process(source.filter("offset < 3").withColumn("offset", F.col("offset") + 20).select("*", at), 1)
    assert sorted(r["offset"] for r in job.stored.read().collect()) == [0, 1, 2, 20, 21, 22]
    reasons = {r["offset"]: r["reasons"] for r in job.rejects.read().collect()}
    assert reasons == {10: ["bad frame"], 11: ["unknown schema"], 12: ["undecodable body"], 13: ["title is missing"], 14: ["created_at is not a time"],
                       15: ["bad frame"]}
    line = job.stored.read().filter("offset = 0").first()
    assert line["line_item_id"] == 0 and line["shopify_created_at"] is not None


def test_products_are_ingested_once_into_both_tables(spark, tmp_path):
    variant = lambda k, price="1.50": {"id": k, "title": "S", "price": price, "taxable": True}
    product = lambda k, *variants, **kw: json.dumps({"event_id": f"e{k}", "id": k, "title": "T", "variants": list(variants), **kw})
    frame = lambda text: b"\x00\x00\x00\x00\x01" + text.encode()
    values = [frame(product(1, variant(10), variant(11), created_at="2024-01-01T10:00:00Z")), frame(product(2)), frame(product(3, variant(30, "dear"))),
              b"\x01", None, frame(product(6, variant(60), unheard_of=5))]
    columns = "topic string, partition int, offset bigint, value binary"
    source = spark.createDataFrame([("products", 0, k, v) for k, v in enumerate(values)], columns)
    registry = spark.createDataFrame([(1, "x")], "schema_id bigint, schema_json string")
    # The writers' schema has no vendor, the declared one has.
    written = T.StructType([f for f in schemas.RAW_PRODUCTS if f.name != "vendor"])
    job = consumer.TopicIngest(spark, str(tmp_path / "job"), "products", registry, consumer.json_record(written))

    def run():
        src = spark.readStream.schema(columns).parquet(str(tmp_path / "in"))
        job.start(src, str(tmp_path / "ck"), NOW).awaitTermination(240)

    source.filter("offset < 5").unionByName(source.filter("offset = 0")).coalesce(1).write.parquet(str(tmp_path / "in"))
    run()
    source.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # all again, and a new one
    run()
    job.process(source, 1)  # the last batch once more
    products = {r["id"]: r for r in job.read("products").collect()}
    assert sorted(products) == [1, 2, 6] and job.read("products").count() == 3
    assert products[1]["vendor"] is None and products[1]["created_at"] == datetime(2024, 1, 1, 10)
    variants = job.read("product_variants")
    assert sorted((r["product_id"], r["variant_id"], str(r["price"])) for r in variants.collect()) == [(1, 10, "1.50"), (1, 11, "1.50"), (6, 60, "1.50")]
    reasons = sorted((r["offset"], r["reasons"]) for r in job.rejects.read().collect())
    assert reasons == [(2, ["a variant's price is not an amount"]), (3, ["bad frame"]), (4, ["bad frame"])]


@pytest.mark.parametrize("topic,table,fields", [
    ("inventory", "inventory_levels", {"inventory_item_id": 5, "available": 2}), ("customers", "customers", {"id": 5, "email": "a@b"}),
    ("order_details", "order_details", {"id": 5, "price": "2.345", "total_discount": "0"})])
def test_every_topic_is_ingested(spark, tmp_path, topic, table, fields):
    body = lambda **kw: b"\x00\x00\x00\x00\x01" + json.dumps(fields | kw).encode()
    rows = [(topic, 1, 0, body()), (topic, 1, 1, body(price="x")), (topic, 1, 2, b"\x00\x00\x00\x00\x09{}")]
    source = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary")
    registry = spark.createDataFrame([(1, "x")], "schema_id bigint, schema_json string")
    job = consumer.TopicIngest(spark, str(tmp_path), topic, registry, consumer.json_record(schemas.TOPIC_SCHEMAS[topic]))
    job.process(source, 0)
    got = job.read(table).collect()
    assert len(got) == (1 if topic == "order_details" else 2)
    assert all(r[c] == v for r in got for c, v in fields.items() if c not in ("price", "total_discount"))
    want = {2: ["unknown schema"]} | ({1: ["price is not an amount"]} if topic == "order_details" else {})
    assert {r["offset"]: r["reasons"] for r in job.rejects.read().collect()} == want


def test_health_names_a_job_that_fails(spark, tmp_path):
    table = health.ProgressTable(spark, str(tmp_path / "progress"))
    log = health.ProgressLog(table)
    spark.streams.addListener(log)
    try:
        spark.createDataFrame([(1,)], "v int").write.parquet(str(tmp_path / "in"))
        src = spark.readStream.schema("v int").parquet(str(tmp_path / "in"))
        for name, fails in (("fine", False), ("orders", True)):
            out = src.select(F.when(F.lit(fails), F.raise_error("broken").cast("int")).otherwise(F.col("v")).alias("v"))
            q = out.writeStream.queryName(name).format("noop").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
            try:
                q.awaitTermination(120)
            except Exception:
                assert fails
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(60):
            got = {r["job"]: (r["completed"] > 0, r["failed"]) for r in health.query_health(table.read()).collect()}
            if len(got) == 2:
                break
            time.sleep(0.5)
        assert got["fine"] == (True, 0) and got["orders"][1] == 1 and set(got) == {"fine", "orders"}
    finally:
        spark.streams.removeListener(log)


def test_live_counters_in_update_mode(spark, tmp_path):
    df = spark.createDataFrame([("t", "produced"), ("t", "error"), ("u", "pause"), ("t", "produced")], "topic string, kind string")
    df.write.json(str(tmp_path / "in"))
    src = spark.readStream.schema(df.schema).json(str(tmp_path / "in"))
    q = metrics.stream_counters(src).writeStream.outputMode("update").format("memory").queryName("live").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert {tuple(r) for r in spark.table("live").collect()} == {("t", 2, 1, 0), ("u", 0, 0, 1)}


def test_stream_static_enrichment(spark, tables, tmp_path):
    from cartstream.operators import enrich
    from cartstream.plans.event_queries import lookup

    items = a.raw_order_details(tables).select(
        F.col("variant_id").alias("inventory_item_id"), "event_id", "order_id", "title", "price", "grams", "sku")
    items.write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(items.schema).parquet(str(tmp_path / "in"))
    q = jobs.append_stream(enrich.enrich_order_details(src, lookup(tables)), str(tmp_path / "out"), str(tmp_path / "ck"), trigger=NOW)
    q.awaitTermination(240)
    same(spark.read.parquet(str(tmp_path / "out")), enrich.enrich_order_details(items, lookup(tables)))


def test_health_counts_restarts_and_failures(spark):
    lines = [
        health.progress_row({"name": "j", "runId": r, "batchId": b, "timestamp": f"2024-01-01T00:00:{s:02d}Z", "numInputRows": n,
                             "durationMs": {"triggerExecution": 5, "commitOffsets": c}}, failed)
        for r, b, s, n, c, failed in [("r1", 0, 0, 10, 3, False), ("r1", 1, 20, None, 4, True), ("r2", 1, 50, 7, 9, False)]
    ]
    df = spark.createDataFrame([(json.dumps(x),) for x in lines], "line string").select(
        F.from_json("line", health.PROGRESS).alias("p")).select("p.*")
    (r,) = health.query_health(df).collect()
    assert (r["uptime_seconds"], r["restarts"], r["last_commit_ms"], r["completed"], r["failed"], r["input_rows"]) == (50.0, 1, 9, 2, 1, 17)


def test_startup_options():
    assert kafka_options("t", "s", "latest")["startingOffsets"] == "latest"
    assert kafka_options("t", "s", "committed", "g")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka_options("t", "s", "now")
