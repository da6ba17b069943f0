"""Ingest, wire format, sinks, catalog, exploration, checks and upkeep on small frames."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from cartstream import schemas
from cartstream.operators import deep_pages, enrich, explorer, ingest, maintain, quality
from cartstream.session import checkpoint_dir, scratch, unsorted_writes
from cartstream.sinks import writers
from cartstream.sources import tables as tb
from cartstream.sources import wire
from cartstream.sources.topics import read_samples, with_header_defaults
from cartstream.streaming import consumer
from cartstream.streaming.dedup import dedup_events

T0 = datetime(2024, 1, 1)


# -- ingest and wire ---------------------------------------------------------

def product(spark, variants):
    cols = {f.name: None for f in schemas.RAW_PRODUCTS} | {"event_id": "e", "id": 1, "variants": variants}
    return spark.createDataFrame([tuple(cols.values())], schemas.RAW_PRODUCTS)


def variant(**kw):
    return tuple(({f.name: None for f in schemas.RAW_PRODUCTS["variants"].dataType.elementType} | kw).values())


def test_products_without_variants_give_no_rows(spark):
    assert ingest.to_product_variants(product(spark, None)).count() == 0
    assert ingest.to_product_variants(product(spark, [])).count() == 0


def test_variant_parent_id_and_key(spark):
    rows = ingest.to_product_variants(product(spark, [variant(id=5, product_id=99, price="1.005"), variant(id=6, event_id="own")]))
    got = [(r["event_id"], r["product_id"], str(r["price"])) for r in rows.orderBy("variant_id").collect()]
    assert got == [("e:5", 1, "1.01"), ("own", 1, "None")]
    assert rows.schema == schemas.LAKE_VARIANTS or quality.schema_drift(rows, schemas.LAKE_VARIANTS).count() == 0


def test_projections_have_the_lake_schemas(spark):
    for topic, outputs in ingest.TOPIC_OUTPUTS.items():
        raw = spark.createDataFrame([], schemas.TOPIC_SCHEMAS[topic])
        for table, project in outputs.items():
            assert quality.schema_drift(project(raw), schemas.LAKE_TABLES[table]).count() == 0


def test_frames(spark):
    good, bad = bytes([0, 0, 0, 1, 2]) + b"body", bytes([1, 0, 0, 0, 2]) + b"x"
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(bad)), (3, bytearray(b"\0\0")), (4, None)], "id int, value binary")
    got = {r["id"]: (r["frame_ok"], r["schema_id"], r["body"]) for r in wire.split_frame(df, on_bad="quarantine").collect()}
    assert got[1] == (True, 258, b"body")
    assert got[2] == got[3] == got[4] == (False, None, None)
    assert wire.split_frame(df.filter("id = 1")).first()["schema_id"] == 258
    with pytest.raises(Exception, match="bad frame"):
        wire.split_frame(df).collect()


def test_unknown_schema_id_raises(spark):
    df = spark.createDataFrame([(1,), (2,)], "schema_id bigint")
    registry = spark.createDataFrame([(1, "{}")], "schema_id bigint, schema_json string")
    with pytest.raises(Exception, match="unknown schema id 2"):
        wire.attach_schema(df, registry).collect()
    assert wire.unknown_schemas(df, registry).collect() == [(2, 1)]


def decoded_messages(spark):
    frame = lambda k, body: bytearray(b"\0\0\0\0" + bytes([k]) + body.encode())
    good = [(o, frame(1, f'{{"id": {o}, "title": "t{o}"}}')) for o in range(40)]
    rows = [("t", 0, o, v) for o, v in [*good, (40, frame(1, "{")), (41, frame(9, "{}")), (42, bytearray(b"\1")), (43, None)]]
    messages = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary")
    registry = spark.createDataFrame([(1, "x")], "schema_id bigint, schema_json string")
    schema = T.StructType.fromDDL("id bigint, title string")
    return consumer.decoded(messages, registry, consumer.json_record(schema), schema)


@pytest.mark.parametrize("hot_rows,exchanges", [(1, None), (50, None), (1000, 1)])
def test_usual_products_have_their_lines_dealt_out_once(spark, hot_rows, exchanges):
    lines = spark.range(300).selectExpr(
        "CAST(id AS string) AS event_id", "id DIV 2 AS id", "id AS order_id", "1 AS variant_id",
        "CASE WHEN id < 200 THEN 1 WHEN id < 290 THEN id % 7 + 2 END AS product_id", "1 AS quantity", "CAST(1 AS decimal(10,2)) AS price")
    goods = spark.createDataFrame([(k, "A", "active") for k in range(1, 12)], "id bigint, title string, status string")
    out = enrich.product_lines(goods, lines, 30, hot_rows)
    if exchanges:  # of the lines; the products are few here
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == exchanges
    got = {(r["product_id"], r["chunk"]): [x["order_id"] for x in r["lines"]] for r in out.collect()}
    want = {(k, 0): [] for k in range(1, 12)} | {(1, c): list(range(30 * c, min(30 * c + 30, 200))) for c in range(7)}
    want |= {(k, 0): [i for i in range(200, 290) if i % 7 + 2 == k] for k in range(2, 9)}
    assert got == want and out.count() == len(want)


def test_messages_of_one_schema_are_not_dealt_out_by_it(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = decoded_messages(spark)
        assert "hashpartitioning(schema_id" not in rows._jdf.queryExecution().executedPlan().toString()
        assert {r["offset"]: r["_broken"] for r in rows.filter("_broken IS NOT NULL").collect()} == {
            40: "undecodable body", 41: "unknown schema", 42: "bad frame", 43: "bad frame"}
        assert sorted((r["id"], r["title"]) for r in rows.filter("_broken IS NULL").collect()) == [(k, f"t{k}") for k in range(40)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_body_is_decoded_once_whatever_is_tested(spark):
    tested = decoded_messages(spark).filter("_broken IS NULL AND id > 5 AND title <> 't7' AND length(title) < id + 9").select("offset", "id", "title")
    assert tested._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert sorted(r["id"] for r in tested.collect()) == [6, *range(8, 40)]


def test_verdicts_are_the_accepted_and_the_rejected(spark):
    rows = decoded_messages(spark).withColumn("reasons", F.when(F.col("_broken").isNull(), F.array().cast("array<string>")).otherwise(F.array("_broken", "title")))
    got = {r["offset"]: r["verdict"] for r in consumer.verdicts(rows).collect()}
    assert got == {**dict.fromkeys(range(40), "stored"), 40: "undecodable body", 41: "unknown schema", 42: "bad frame", 43: "bad frame"}


def test_avro_needs_the_module(spark):
    df = spark.createDataFrame([(1, bytearray(b""))], "schema_id bigint, body binary")
    with pytest.raises(Exception):
        wire.decode_avro(df, {1: '{"type": "string"}'}).collect()
    with pytest.raises(ValueError):
        wire.decode_avro(df, {})


def test_header_defaults_and_samples(spark, tmp_path):
    df = spark.createDataFrame([(None, None, None, None, "{}", T0)], schemas.LANDED_WEBHOOK)
    assert with_header_defaults(df).first()[:4] == ("unknown", "unknown", "", "")
    spark.createDataFrame([(T0, "m", {"a": "b"}, 1.0)], schemas.SAMPLES).write.parquet(str(tmp_path / "s"))
    assert read_samples(spark, str(tmp_path / "s")).first()["labels"] == {"a": "b"}


# -- sinks -------------------------------------------------------------------

def test_append_partitioned_and_read_back(spark, tmp_path):
    df = spark.range(100).select(F.lit("e").alias("event_id"), F.col("id").alias("inventory_item_id"), (F.col("id") % 3).alias("location_id"))
    for _ in range(2):
        writers.append_table(df, str(tmp_path / "inv"), ["location_id"])
    back = tb.read_table(spark, "inv", str(tmp_path))
    assert back.count() == 200 and back.filter("location_id = 1").count() == 66


def test_publish_keys(spark, tmp_path):
    df = spark.createDataFrame([(7, 1, "a"), (7, 2, "b"), (9, 1, "c")], "order_id bigint, n int, v string")
    assert [tuple(r)[:2] for r in writers.to_messages(df, "order_details").orderBy("key", "value").collect()] == [
        ("order_details", "7"), ("order_details", "7"), ("order_details", "9")]
    writers.publish_files(df, str(tmp_path), "order_details", order="n")
    assert spark.read.json(str(tmp_path / "order_details")).count() == 3


def test_insert_unique(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["topic", "partition", "offset"]
    df = spark.createDataFrame([("t", 0, 1, "a"), ("t", 0, 2, "b")], "topic string, partition int, offset bigint, v string")
    writers.insert_unique(df, path, keys, ["v"])
    more = spark.createDataFrame([("t", 0, 2, "x"), ("t", 1, 2, "y"), ("t", 1, 2, "z")], df.schema)
    with pytest.raises(Exception, match="duplicate key"):
        writers.insert_unique(more, path, keys, ["v"])
    assert spark.read.parquet(path).count() == 2
    writers.insert_unique(more, path, keys, ["v"], on_conflict="skip")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ["a", "b", "y"]
    assert writers.key_conflicts(more, keys).first()["n_rows"] == 2


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you', None), (2, "two\nlines", "z")], "a int, b string, c string")
    writers.export_csv(df.coalesce(1), str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert text == 'a,b,c\n1,"say ""hi"", you",\n2,"two\nlines",z\n'
    writers.export_json(df.coalesce(1), str(tmp_path / "json"))
    assert '"c":null' in "".join(p.read_text() for p in (tmp_path / "json").glob("*.json"))


# -- catalog -----------------------------------------------------------------

def test_tables_are_created_once_and_replaced_on_request(spark):
    name = "cart_inventory"
    for _ in range(2):
        tb.ensure_table(spark, name, schemas.LAKE_INVENTORY, partition_by=["location_id"], props={"gc.enabled": "true"})
        spark.sql(f"INSERT INTO {name} VALUES ('e', 1, 5, timestamp_ntz'2024-01-01 00:00:00', 2)")
    assert tb.read_table(spark, name).count() == 2
    tb.set_properties(spark, name, {"note": "x"})
    assert spark.sql(f"SHOW TBLPROPERTIES {name}").filter("key = 'note'").count() == 1
    assert explorer.list_tables(spark).filter(F.col("table_name") == name).count() == 1
    assert explorer.list_columns(spark, name).count() == 5
    tb.ensure_table(spark, name, schemas.LAKE_INVENTORY, replace=True)
    assert tb.read_table(spark, name).count() == 0
    tb.drop_table(spark, name)
    assert explorer.readable(lambda: spark.table(name)) is None


def test_evolve(spark):
    old = spark.createDataFrame([(1, 2)], "inventory_item_id int, extra int")
    new = tb.evolve(old, schemas.RAW_INVENTORY)
    assert new.columns == [*schemas.RAW_INVENTORY.names, "extra"]
    assert tb.append_evolved([new, spark.createDataFrame([], schemas.RAW_INVENTORY)]).count() == 1


# -- exploration -------------------------------------------------------------

@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, f"Name_{i}%", i % 3 == 0, T0 + timedelta(days=i), i % 4) for i in range(20)]
    return spark.createDataFrame(rows, "id int, title string, ok boolean, created_at timestamp_ntz, grp int")


def test_filters(people):
    n = lambda spec: explorer.apply_filters(people, spec).count()
    assert n({"title": "NAME_1%"}) == 1 and n({"title": "_"}) == 20 and n({"title": "%%"}) == 0
    assert n({"ok": "TRUE"}) == 7 and n({"id": "1"}) == 11
    assert n({"title": "  ", "nope": "x"}) == 20
    rng = {"gte": "2024-01-03T00:00:00", "lte": "2024-01-05T00:00:00"}
    assert n({"created_at": rng}) == 3 and n({"created_at": rng, "id": "2"}) == 1
    assert n({"created_at": {"gte": "x", "lte": "2024-01-05"}}) == 20 and n({"id": {"gte": "1", "lte": "2"}}) == 20


def test_range_filter_reaches_the_scan(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "p"))
    df = explorer.filter_range(spark.read.parquet(str(tmp_path / "p")), "created_at", "2024-01-03T00:00:00", "2024-01-05T00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan and "LessThanOrEqual(created_at" in plan


def test_pages_by_offset_and_by_key_agree(people):
    by_offset = [[r["id"] for r in explorer.page(people, None, "grp", "desc", p, 6).collect()] for p in (1, 2, 3, 4)]
    assert [len(p) for p in by_offset] == [6, 6, 6, 2]
    last, by_key = None, []
    while rows := explorer.page_after(people, last, "grp", "desc", 6).collect():
        by_key.append([r["id"] for r in rows])
        last = rows[-1].asDict()
    assert by_key == by_offset


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_by_key_list_nulls(spark, order):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 5), (5, 1), (6, None)], "id int, v int")
    last, seen = None, []
    while rows := explorer.page_after(df, last, "v", order, 2).collect():
        seen += [r["id"] for r in rows]
        last = rows[-1].asDict()
    assert seen == [r["id"] for r in explorer.page(df, None, "v", order, 1, 10).collect()]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_times_do_not_depend_on_the_drivers_zone(spark, monkeypatch, kind):
    rows = spark.sql(f"SELECT id, CAST(concat('1997-01-0', id, ' 00:30:00') AS {kind}) AS created_at FROM VALUES (1), (2), (3) AS t(id)")
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        found = explorer.filter_range(rows, "created_at", "1997-01-02T00:00:00", datetime(1997, 1, 2, 23)).collect()
        assert [r["id"] for r in found] == [2]
        first = explorer.page_after(rows, None, "created_at", "asc", 1).collect()[0]
        assert [r["id"] for r in explorer.page_after(rows, first.asDict(), "created_at", "asc", 5).collect()] == [2, 3]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_a_corrupt_table_spoils_no_other_count(spark, people, tmp_path):
    (tmp_path / "bad").mkdir()
    people.limit(1).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"PAR1 not parquet PAR1")
    bad = spark.read.schema(people.schema).parquet(str(tmp_path / "bad"))
    counts = {r["table_name"]: r for r in explorer.table_counts({"bad": bad, "p": people}).collect()}
    assert counts["p"]["n_rows"] == 20 and counts["p"]["error"] is None and counts["bad"]["n_rows"] == 0 and counts["bad"]["error"]


@pytest.mark.parametrize("sql", ["SELECT java_method('java.lang.System', 'getProperty', 'x')", "select reflect ('a','b')", "SELECT `reflect`('a', 'b')",
                                 "SELECT * FROM parquet.`/etc/x`"])
def test_read_only_refuses_what_reaches_beyond_the_tables(spark, sql):
    with pytest.raises(explorer.NotReadOnly):
        explorer.read_only_sql(spark, sql)


def test_read_only_keeps_the_callers_views(spark, people):
    people.limit(3).createOrReplaceTempView("mine")
    with pytest.raises(Exception, match="(?i)already exists"):
        explorer.read_only_sql(spark, "SELECT * FROM mine", {"mine": people})
    assert spark.table("mine").count() == 3
    spark.catalog.dropTempView("mine")
    assert explorer.read_only_sql(spark, "SELECT count(*) AS n FROM theirs", {"theirs": people}).first()["n"] == 20
    assert not spark.catalog.tableExists("theirs")


def test_white_space_is_missing(spark):
    df = spark.createDataFrame([("a",), ("\t",), ("\n \u00a0\u2003",), ("",), (None,)], "v string")
    ok, refused = quality.validate(df, ["v"])
    assert [r["v"] for r in ok.collect()] == ["a"] and refused.count() == 4


def test_checkpoint_folder_must_be_shared_off_local_masters():
    class Conf:
        get = staticmethod(lambda key, default=None: None)

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(type("Session", (), {"conf": Conf, "sparkContext": Context})())


def test_scratch_tables_can_be_dropped(spark, people):
    with scratch(people) as kept:
        assert kept.df.count() == 20
        path = kept.path
    assert explorer.readable(lambda: spark.read.parquet(path)) is None
    assert [r["id"] for r in explorer.page(people, None, "nope", limit=3).collect()] == [0, 1, 2]
    assert explorer.page_totals(people, {"id": "1"}, 5).first() == (11, 3)


def test_recent_counts_and_health(spark, people):
    assert [r["id"] for r in explorer.recent_events(people, 2).collect()] == [19, 18]
    assert explorer.last_event(people).first()["id"] == 19
    assert explorer.event_health(people.limit(0)).first() == (0, 0, False)
    gone = explorer.readable(lambda: spark.read.parquet("/no/such/place"))
    assert sorted(map(tuple, explorer.table_counts({"p": people, "gone": gone}).drop("error").collect())) == [("gone", 0), ("p", 20)]


@pytest.mark.parametrize("sql", ["select 1 as x", "WITH a AS (SELECT 1 AS x) SELECT * FROM a;", "select 'drop; table' as x -- note",
                                 "/* c */ SELECT 1 AS x"])
def test_read_only_accepts(spark, sql):
    assert explorer.read_only_sql(spark, sql).count() == 1


@pytest.mark.parametrize("sql", ["DROP TABLE x", "insert into t values (1)", "select 1; drop table x", "-- select\ndelete from t", "",
                                 "x\nSELECT 1", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "with a as (select 1) delete from t"])
def test_read_only_refuses(spark, sql):
    with pytest.raises(explorer.NotReadOnly):
        explorer.read_only_sql(spark, sql)


# -- checks ------------------------------------------------------------------

def test_validation_reasons(spark):
    df = spark.createDataFrame([("a", True), (" ", None), (None, False)], "t string, b boolean")
    ok, bad = quality.validate(df, ["t"], ["b"])
    assert ok.count() == 1
    assert sorted(map(str, (r["reasons"] for r in bad.collect()))) == ["['t is missing', 'b is not true or false']", "['t is missing']"]


def test_quality_and_uniqueness(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3)], "k string, v int")
    got = {(r["rule"], r["column"]): r["violations"] for r in quality.quality_report(df, ["k", "v"], ["k", "v"]).collect()}
    assert got == {("not_null", "k"): 2, ("not_null", "v"): 1, ("unique", "k"): 1, ("unique", "v"): 0}
    assert quality.unique_violations(df, ["k"]).collect() == [("a", 2)]


def test_schema_drift(spark):
    df = spark.createDataFrame([], "a int, b string, d int")
    want = spark.createDataFrame([], "a int, b int, c int").schema
    assert sorted(map(tuple, quality.schema_drift(df, want).collect())) == [("b", "int", "string"), ("c", "int", None), ("d", None, "int")]


def test_empty_dimension_keeps_nothing_and_null_keys_pass_foreign_keys(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "k int, v string")
    none = spark.createDataFrame([], "id int")
    assert enrich.keep_known(df, none, "k", "id").count() == 0
    ok, bad = enrich.fk_check(df, spark.createDataFrame([(1,)], "id int"), "k")
    assert sorted(r["v"] for r in ok.collect()) == ["x", "y"] and [r["v"] for r in bad.collect()] == ["z"]
    left = enrich.cascade_delete(df, spark.createDataFrame([(2,)], "id int"), "k")
    assert sorted(r["v"] for r in left.collect()) == ["x", "y"]


def test_lookup_is_bounded_by_age(spark):
    df = spark.createDataFrame([(1, 1, T0), (1, 2, T0 + timedelta(days=2)), (2, 3, T0)], "inventory_item_id int, variant_id int, updated_at timestamp_ntz")
    assert {r["inventory_item_id"]: r["variant_id"] for r in enrich.variant_lookup(df).collect()} == {1: 2, 2: 3}
    recent = enrich.variant_lookup(df, "1 day", "2024-01-03 00:00:00")
    assert [r["variant_id"] for r in recent.collect()] == [2]


def test_dedup_events_keeps_null_ids(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, o int")
    assert sorted(r["o"] for r in dedup_events(df, "k", ["o"]).collect()) == [1, 2, 3]


# -- upkeep ------------------------------------------------------------------

def test_snapshot_expiry_keeps_the_newest_five(spark):
    now = T0 + timedelta(hours=5)
    times = [now - timedelta(minutes=10)] + [now - timedelta(hours=1, minutes=m) for m in range(1, 8)]
    df = spark.createDataFrame([("t", i, c) for i, c in enumerate(times)], "table_name string, snapshot_id int, committed_at timestamp_ntz")
    assert sorted(r["snapshot_id"] for r in maintain.expired_snapshots(df, str(now)).collect()) == [5, 6, 7]


def test_rewrite_keeps_rows_and_merges_files(spark, tmp_path):
    src, dst = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(2000).withColumn("p", F.col("id") % 2).repartition(12).write.partitionBy("p").parquet(src)
    assert maintain.rewrite(spark, src, dst, ["p"]) == (2000, 2000)
    n = lambda p: maintain.list_files(spark, p, ["p"]).count()
    assert n(src) == 24 and n(dst) == 2
    assert maintain.due(spark, src, ["p"]) and not maintain.due(spark, dst, ["p"])
    # Many bins: each becomes one file of about the target.
    mean = maintain.list_files(spark, src, ["p"]).agg(F.avg("size_bytes")).first()[0]
    target, many = int(3 * mean), str(tmp_path / "c")
    maintain.rewrite(spark, src, many, ["p"], target)
    sizes = [r["size_bytes"] for r in maintain.list_files(spark, many, ["p"]).collect()]
    bins = maintain.compaction_groups(maintain.plan_compaction(maintain.list_files(spark, src, ["p"]), ["partition"], target), ["partition"]).count()
    assert len(sizes) == bins >= 8 and max(sizes) < 2 * target
    assert spark.read.parquet(many).exceptAll(spark.read.parquet(dst)).count() == 0
    assert spark.read.parquet(src).exceptAll(spark.read.parquet(dst)).count() == 0


def test_a_rewrite_does_not_sort_its_bins(spark, tmp_path, monkeypatch):
    key, during = "spark.sql.maxConcurrentOutputFileWriters", []
    spark.sql("CREATE TABLE unsorted (id bigint, p bigint) USING parquet PARTITIONED BY (p)")
    plan = lambda: spark.sql("EXPLAIN INSERT INTO unsorted SELECT id, id % 3 FROM range(9)").first()[0]
    try:
        with unsorted_writes(spark):
            assert "Sort [" not in plan()
        assert "Sort [" in plan()
    finally:
        spark.sql("DROP TABLE unsorted")
    written = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (during.append(spark.conf.get(key)), written(self, *a, **b)))
    src, dst = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(30).withColumn("p", F.col("id") % 20).repartition(3).write.partitionBy("p").parquet(src)
    assert maintain.rewrite(spark, src, dst, ["p"]) == (30, 30)
    assert during[-1] != "0" and spark.conf.get(key) == "0"
    assert spark.read.parquet(src).exceptAll(spark.read.parquet(dst)).count() == 0


def test_bins_hold_less_than_target_plus_one_file(spark):
    df = spark.createDataFrame([("p", f"f{i:03d}", 30) for i in range(20)], "partition string, file_path string, size_bytes bigint")
    bins = maintain.compaction_groups(maintain.plan_compaction(df, ["partition"], 100, slices=3), ["partition"]).collect()
    assert sum(r["n_files"] for r in bins) == 20 and all(r["size_bytes"] < 130 for r in bins)


def test_maintenance_goes_on_after_a_failure(spark):
    done = []
    def boom():
        raise RuntimeError("no space")
    out = maintain.maintain(spark, {"a": [("compact", boom), ("expire", lambda: done.append("never"))], "b": [("compact", lambda: done.append("b"))]})
    assert done == ["b"]
    assert [(r["table_name"], r["ok"]) for r in out.orderBy("table_name").collect()] == [("a", False), ("b", True)]
    calls = maintain.catalog_calls("lake", "db.t", "2024-01-01 00:00:00")
    assert len(calls) == 4 and "134217728" in calls[0] and "retain_last => 5" in calls[3]


def test_ten_small_files_rewrite_one_bin(spark, tmp_path):
    root, names = str(tmp_path / "t"), lambda: {f.relative_to(tmp_path): f.stat().st_ino for f in tmp_path.rglob("*.parquet")}
    rows = lambda a, b, p: spark.range(a, b).select("id", F.lit(p).cast("string").alias("day"))
    for p in ("2024-01-01", "2024-01-02", None):
        maintain.append_to_bins(rows(0, 3000, p).coalesce(1), root, ["day"], target=10_000)
    before = names()
    assert len(before) == 3 and maintain.compact_bins(spark, root, ["day"]) == 0 and names() == before
    for k in range(10):
        maintain.append_to_bins(rows(3000 + k, 3001 + k, "2024-01-02").coalesce(1), root, ["day"], target=10_000)
    assert len(names()) == 13 and maintain.compact_bins(spark, root, ["day"]) == 1
    after = names()
    assert len(after) == 4 and {f: i for f, i in after.items() if f in before} == before  # the full bins' files are untouched
    got = maintain.read_bins(spark, root)
    assert got.columns == ["id", "day"] and got.count() == 9010 and got.filter("day IS NULL").count() == 3000
    assert sorted(r["id"] for r in got.filter("day = '2024-01-02' AND id >= 3000").collect()) == list(range(3000, 3010))


def test_replays_with_gaps_and_overlaps(spark):
    import random

    from cartstream.operators import offsets

    rnd, keys = random.Random(3), ["topic", "partition"]
    frame = lambda rows: spark.createDataFrame(rows, "topic string, partition int, offset bigint")
    pool = [(t, p, o) for t in ("a", "b", None) for p in (0, 1) for o in range(60)]
    known, seen = None, set()
    for _ in range(4):
        batch = rnd.sample(pool, 70)
        fresh = frame(batch) if known is None else offsets.not_consumed(frame(batch), offsets.united(known, keys), keys, width=7)
        assert sorted(map(str, map(tuple, fresh.collect()))) == sorted(map(str, set(batch) - seen))
        seen |= set(batch)
        own = offsets.islands(frame(batch + batch[:9]), keys, width=7)
        known = own if known is None else known.unionByName(own)
    got = [tuple(r) for r in offsets.united(known, keys).collect()]
    assert {(t, p, o) for t, p, a, b in got for o in range(a, b + 1)} == seen
    assert all((t, p, b + 1) not in seen for t, p, _, b in got)
    assert offsets.not_consumed(frame([("a", 0, None)]), offsets.united(known, keys), keys).count() == 1


@pytest.mark.parametrize("sql", ["SELECT * FROM `text`.`/etc/hosts`", "SELECT * FROM text.`secret.txt`", "SELECT (SELECT max(value) FROM text.`x`) FROM p",
                                 "WITH a AS (SELECT * FROM csv.`x`) SELECT * FROM a", "SELECT * FROM other", "SELECT 1 WHERE 1 IN (SELECT 1 FROM `json`.`y`)"])
def test_read_only_refuses_relations_not_on_offer(spark, people, sql):
    with pytest.raises(explorer.NotReadOnly):
        explorer.read_only_sql(spark, sql, {"p": people})
    sql = "WITH a AS (SELECT id FROM p), b AS (SELECT * FROM A) SELECT count(*) AS n FROM b WHERE id IN (SELECT id FROM P)"
    assert explorer.read_only_sql(spark, sql, {"p": people}).first()["n"] == 20


def test_versions_are_compacted_and_expired(spark, tmp_path):
    t = maintain.VersionedTable(spark, str(tmp_path / "t"), ["p"])
    with pytest.raises(FileNotFoundError):
        t.read()
    rows = spark.range(300).withColumn("p", F.col("id") % 2)
    t.replace(rows.repartition(6))
    out = maintain.maintain(spark, {"t": [("compact", t.compact), ("expire", t.expire)]})
    assert [r["ok"] for r in out.collect()] == [True, True] and t.versions() == [1, 2]
    assert t.read().count() == 300 and maintain.list_files(spark, t.path(), ["p"]).count() == 2
    (tmp_path / "t" / "version=3").mkdir()  # a run that did not finish
    assert t.versions() == [1, 2] and t.compact() == 2  # nothing to do
    assert t.replace(rows.repartition(6)) == 3
    for _ in range(3):
        t.replace(rows)
    assert t.replace(rows.repartition(6)) == 7 and t.compact() == 8
    later = datetime.now() + timedelta(days=1)
    assert t.expire(later) == [1, 2, 3] and t.versions() == [4, 5, 6, 7, 8]
    assert t.expire(later) == [] and t.read().count() == 300


def test_unknown_table_is_an_error(people):
    assert explorer.table_named({"p": people}, "p") is people
    with pytest.raises(ValueError, match="no table named"):
        explorer.table_named({"p": people}, "q")


def test_deep_pages_equal_the_full_sort(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, "a", "a", "a", "b"])) for i in range(997)]
    df = spark.createDataFrame(rows, "id bigint, v string").repartition(5)
    for order in ("asc", "desc"):
        index = deep_pages.PageIndex(spark, str(tmp_path / order), "v", order).build(df, bucket_rows=90)
        assert index.counts.count() > 8 and index.total() == 997
        for number in (1, 5, 100, 101):
            want = explorer.page(df, None, "v", order, number, 10)
            assert index.page(number, 10).collect() == want.collect()
    empty = deep_pages.PageIndex(spark, str(tmp_path / "none"), "v").build(df.limit(0))
    assert (empty.total(), empty.counts.count(), empty.page(1).count()) == (0, 0, 0)


def test_a_best_seller_has_chunks_of_bounded_size(spark):
    lines = spark.range(500).selectExpr(
        "CAST(id AS string) AS event_id", "id DIV 2 AS id", "id AS order_id", "1 AS variant_id",
        "CASE WHEN id < 450 THEN 1 WHEN id < 460 THEN 2 END AS product_id", "1 AS quantity", "CAST(1 AS decimal(10,2)) AS price")
    goods = spark.createDataFrame([(1, "A", "active"), (2, "B", "active"), (3, "C", "draft")], "id bigint, title string, status string")
    got = enrich.product_lines(goods, lines, 100).orderBy("product_id", "chunk").collect()
    assert [(r["product_id"], r["chunk"], len(r["lines"])) for r in got] == [
        (1, 0, 100), (1, 1, 100), (1, 2, 100), (1, 3, 100), (1, 4, 50), (2, 0, 10), (3, 0, 0)]
    assert [x["order_id"] for r in got[:5] for x in r["lines"]] == list(range(450))


@pytest.mark.parametrize("name", ["ingest_framed_products", "ingest_framed_variants", "ingest_framed_customers", "framed_rejects"])
def test_messages_come_from_many_partitions(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == plan.count("Relation [")
