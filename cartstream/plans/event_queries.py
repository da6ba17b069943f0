"""Queries over event streams: ingest, wire format, scalar functions, checks, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartstream import functions as fn
from cartstream import schemas
from cartstream.operators import claims, enrich, handles, ingest, quality
from cartstream.operators.upsert import latest_by_key
from cartstream.plans import adapters as a
from cartstream.plans.registry import query
from cartstream.sinks.writers import insertable
from cartstream.sources import tables as tb
from cartstream.sources import wire
from cartstream.streaming import consumer
from cartstream.streaming.dedup import dedup_events


def wall(c: str) -> str:
    return f"try_strptime(left({c}, 19), '%Y-%m-%dT%H:%M:%S')"


def dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(10,2))"


LINES = f"({a.sql_frame(a.ORDER_DETAILS, 'lineitem')})"
LEVELS = f"({a.sql_frame(a.INVENTORY, 'lineitem')})"
PEOPLE = f"({a.sql_frame(a.CUSTOMERS, 'customer')})"
GOODS = f"({a.sql_frame(a.PRODUCTS, 'part')})"
VARIANTS = f"({a.SQL_VARIANTS})"


# -- ingest ------------------------------------------------------------------

@query("ingest_products", f"""
SELECT event_id, id, title, vendor, product_type, handle, status, tags, {wall('created_at')} AS created_at,
       {wall('updated_at')} AS updated_at, {wall('published_at')} AS published_at
FROM {GOODS}""")
def ingest_products(t):
    return ingest.to_products(a.raw_products(t))


@query("ingest_inventory", f"""
SELECT event_id, inventory_item_id, location_id, available, {wall('updated_at')} AS updated_at FROM {LEVELS}""")
def ingest_inventory(t):
    return ingest.to_inventory_levels(a.raw_inventory(t))


SQL_ORDER_DETAILS = f"""
SELECT event_id, order_id, id, variant_id, product_id, title, variant_title, name, sku, vendor, quantity,
       fulfillable_quantity, current_quantity, {dec('price')} AS price, {dec('total_discount')} AS total_discount,
       fulfillment_service, fulfillment_status, requires_shipping, taxable, gift_card, product_exists,
       variant_inventory_management, {wall('created_at')} AS created_at, {wall('updated_at')} AS updated_at
FROM {LINES}"""


@query("ingest_order_details", SQL_ORDER_DETAILS)
def ingest_order_details(t):
    return ingest.to_order_details(a.raw_order_details(t))


@query("ingest_customers", f"""
SELECT event_id, id, email, first_name, last_name, phone, state, verified_email, tags,
       {wall('created_at')} AS created_at, {wall('updated_at')} AS updated_at
FROM {PEOPLE}""")
def ingest_customers(t):
    return ingest.to_customers(a.raw_customers(t))


SQL_PRODUCT_VARIANTS = f"""
SELECT coalesce(event_id, 'p-' || CAST(product_id AS VARCHAR) || ':' || CAST(id AS VARCHAR)) AS event_id,
       product_id, id AS variant_id, title, {dec('price')} AS price, sku, position, inventory_policy,
       {dec('compare_at_price')} AS compare_at_price, fulfillment_service, inventory_management, option1, option2,
       option3, taxable, barcode, CAST(weight AS DOUBLE) AS weight, weight_unit, inventory_item_id,
       inventory_quantity, requires_shipping, {wall('created_at')} AS created_at, {wall('updated_at')} AS updated_at
FROM {VARIANTS}"""


@query("ingest_product_variants", SQL_PRODUCT_VARIANTS)
def ingest_product_variants(t):
    return ingest.to_product_variants(a.raw_products(t))


@query("variant_position", f"""
SELECT product_id, id AS variant_id, place AS list_position, place = position AS agrees
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY product_id ORDER BY id) AS INTEGER) AS place FROM {VARIANTS})""")
def variant_position(t):
    return ingest.explode_variants(a.raw_products(t), position=True).select(
        F.col("id").alias("product_id"), F.col("v.id").alias("variant_id"), "list_position",
        (F.col("list_position") == F.col("v.position")).alias("agrees"),
    )


# The message envelope of an order line: three partitions, offset by order and line.
ENVELOPE = {
    "topic": "'shopify.order_details'", "partition": "cast(order_id % 3 as int)", "offset": "id * 1000 + product_id % 1000",
    "key": a.s("order_id"),
}


def enveloped(t):
    return a.raw_order_details(t).selectExpr(
        "*", *[f"{e} AS `{n}`" for n, e in ENVELOPE.items()], "cast('2024-06-01 00:00:00' as timestamp) AS consumed_at"
    )


@query("consume_order_details", f"""
SELECT {', '.join(f'{e} AS "{n}"' for n, e in ENVELOPE.items())}, TIMESTAMP '2024-06-01 00:00:00' AS consumed_at,
       order_id, id AS line_item_id, variant_id, product_id, title, variant_title, name, sku, vendor, quantity,
       fulfillable_quantity, current_quantity, price, total_discount, fulfillment_service, fulfillment_status,
       grams, requires_shipping, taxable, gift_card, product_exists, variant_inventory_management,
       {wall('created_at')} AS shopify_created_at, {wall('updated_at')} + INTERVAL 5 HOUR AS shopify_updated_at
FROM {LINES}""")
def consume_order_details(t):
    out = ingest.to_consumed_order_details(enveloped(t))
    times = ("consumed_at", "shopify_created_at", "shopify_updated_at")
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in times else c for c in out.columns])


# -- wire format -------------------------------------------------------------

def frames(t):
    """Framed messages: one in thirteen has a wrong first byte, schema ids 1 to 5."""
    first = "CASE WHEN event_id % 13 = 0 THEN '01' ELSE '00' END"
    return t["events"].selectExpr(
        "event_id", "event_type AS topic",
        f"concat(unhex({first} || lpad(hex(1 + event_id % 5), 8, '0')), encode(props, 'UTF-8')) AS value",
    )


@query("frame_split", """
SELECT event_id, event_id % 13 <> 0 AS frame_ok, CASE WHEN event_id % 13 <> 0 THEN 1 + event_id % 5 END AS schema_id,
       CASE WHEN event_id % 13 <> 0 THEN props END AS body
FROM events""")
def frame_split(t):
    out = wire.split_frame(frames(t), on_bad="quarantine")
    return out.select("event_id", "frame_ok", "schema_id", F.decode("body", "UTF-8").alias("body"))


# Schema registry: the first four regions' names stand for schema texts 1 to 4, so id 5 is unknown.
def registry(t):
    return t["region"].selectExpr("cast(r_regionkey + 1 as bigint) AS schema_id", "r_name AS schema_json").filter(
        "schema_id < 5"
    )


@query("schema_attach", """
SELECT e.event_id, e.schema_id, r.schema_json
FROM (SELECT event_id, 1 + event_id % 5 AS schema_id FROM events WHERE event_id % 13 <> 0) e
LEFT JOIN (SELECT r_regionkey + 1 AS schema_id, r_name AS schema_json FROM region WHERE r_regionkey + 1 < 5) r
  ON r.schema_id = e.schema_id""")
def schema_attach(t):
    good = wire.split_frame(frames(t), on_bad="quarantine").filter("frame_ok").select("event_id", "schema_id")
    return wire.attach_schema(good, registry(t), on_unknown="null").select("event_id", "schema_id", "schema_json")


@query("schema_unknown", """
SELECT 1 + event_id % 5 AS schema_id, count(*) AS n_rows FROM events
WHERE event_id % 13 <> 0 AND 1 + event_id % 5 NOT IN (SELECT r_regionkey + 1 FROM region WHERE r_regionkey + 1 < 5)
GROUP BY 1""")
def schema_unknown(t):
    good = wire.split_frame(frames(t), on_bad="quarantine").filter("frame_ok")
    return wire.unknown_schemas(good, registry(t))


# -- scalar functions --------------------------------------------------------

@query("scalar_text", r"""
SELECT p_partkey,
       regexp_replace(replace(lower(p_name || ' & ' || p_brand), ' ', '-'), '[^a-z0-9-]', '', 'g') AS handle,
       len(string_split_regex(lower(p_type) || ', ' || p_brand, ',\s*')) AS n_tags,
       string_split_regex(lower(p_type) || ', ' || p_brand, ',\s*')[2] AS second_tag,
       coalesce(CAST(CASE WHEN p_size % 2 = 0 THEN p_size END AS VARCHAR), '') AS size_text,
       CAST(p_partkey AS VARCHAR) || ':' || coalesce(CAST(CASE WHEN p_size % 2 = 0 THEN p_size END AS VARCHAR), '') AS pair_key,
       CASE WHEN p_size % 3 = 0 THEN 'Default Title' WHEN p_size % 3 = 1 THEN p_brand ELSE p_brand || ' / ' || p_type END AS variant_title,
       p_name || ' - ' || p_type AS line_name,
       'SKU-' || CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size AS VARCHAR) AS sku,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS given_id
FROM part""")
def scalar_text(t):
    tags = F.concat(F.lower("p_type"), F.lit(", "), F.col("p_brand"))
    size = F.when(F.col("p_size") % 2 == 0, F.col("p_size"))
    o1 = F.when(F.col("p_size") % 3 > 0, F.col("p_brand"))
    o2 = F.when(F.col("p_size") % 3 > 1, F.col("p_type"))
    given = F.when(F.col("p_size") % 10 == 0, F.lit("0")).when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(
        F.col("p_size").cast("string"))
    return t["part"].select(
        "p_partkey",
        fn.handle(F.concat("p_name", F.lit(" & "), "p_brand")).alias("handle"),
        F.size(fn.split_tags(tags)).cast("bigint").alias("n_tags"),
        fn.split_tags(tags)[1].alias("second_tag"),
        fn.to_text(size).alias("size_text"),
        fn.composite_key(F.col("p_partkey"), size).alias("pair_key"),
        fn.variant_title(o1, o2).alias("variant_title"),
        fn.line_name(F.col("p_name"), F.col("p_type")).alias("line_name"),
        fn.sku(F.col("p_partkey"), F.col("p_size")).alias("sku"),
        fn.truthy_id(given).alias("given_id"),
    )


@query("scalar_topics", f"""
SELECT event_id, topic,
       CASE WHEN topic LIKE 'products/%' THEN 'products' WHEN topic LIKE 'orders/%' THEN 'order_details'
            WHEN topic LIKE 'customers/%' THEN 'customers' WHEN topic LIKE 'inventory%' THEN 'inventory_levels'
            ELSE 'unknown' END AS table_name,
       CASE WHEN topic LIKE '%/create' THEN 'create' WHEN topic LIKE '%/update' THEN 'update' ELSE 'unknown' END AS operation,
       regexp_replace(split_part(topic, '/', 1), 's$', '') AS type
FROM (SELECT event_id, {a.TOPIC_BY_EVENT} AS topic FROM events)""")
def scalar_topics(t):
    rows = t["events"].selectExpr("event_id", f"{a.TOPIC_BY_EVENT} AS topic")
    c = F.col("topic")
    return rows.select(
        "event_id", "topic", fn.topic_table(c).alias("table_name"), fn.topic_operation(c).alias("operation"),
        fn.topic_type(c).alias("type"),
    )


@query("scalar_tags_prices", """
SELECT p_partkey,
       CASE p_partkey % 4 WHEN 0 THEN 'a,b' WHEN 1 THEN 'x, y' WHEN 2 THEN '' ELSE '' END AS tags,
       CASE WHEN p_partkey % 2 = 0 THEN CAST(CAST(p_size AS DECIMAL(10,2)) / 1 AS DECIMAL(10,2))::VARCHAR
            ELSE p_size::VARCHAR || '.5' END AS price
FROM part""")
def scalar_tags_prices(t):
    tags = """CASE p_partkey % 4 WHEN 0 THEN '["a","b"]' WHEN 1 THEN '"x, y"' WHEN 2 THEN '[]' ELSE 'null' END"""
    price = "CASE WHEN p_partkey % 2 = 0 THEN cast(p_size as string) ELSE '\"' || cast(p_size as string) || '.5\"' END"
    rows = t["part"].selectExpr("p_partkey", f"parse_json({tags}) AS t", f"parse_json({price}) AS p")
    return rows.select("p_partkey", fn.join_tags(F.col("t")).alias("tags"), fn.price_text(F.col("p")).alias("price"))


@query("scalar_money_time", f"""
SELECT event_id, {dec('price')} AS price, TRY_CAST(CASE WHEN l % 2 = 0 THEN 'abc' ELSE price END AS DECIMAL(10,2)) AS price_or_null,
       {wall('updated_at')} AS wallclock, {wall('updated_at')} + INTERVAL 5 HOUR AS instant,
       CAST(floor(epoch({wall('updated_at')} + INTERVAL 5 HOUR)) AS BIGINT) AS unix_time,
       least({wall('updated_at')} + INTERVAL 5 HOUR, TIMESTAMP '1998-01-01 00:00:00') AS clamped,
       CASE WHEN l % 3 = 0 THEN created_at END AS published_at,
       CAST(trunc(grams * 453.592::DOUBLE) AS INTEGER) AS grams, CAST(CAST(grams AS DECIMAL(20,2)) AS VARCHAR) AS grams_text,
       quantity / 1000.0::DOUBLE AS thousandth
FROM (SELECT *, quantity AS l FROM {LINES})""")
def scalar_money_time(t):
    r = a.raw_order_details(t)
    instant = fn.ts_instant(F.col("updated_at"))
    limit = F.lit("1998-01-01 00:00:00").cast("timestamp")
    status = F.when(F.col("quantity") % 3 == 0, F.lit("active")).otherwise(F.col("fulfillment_status"))
    doubtful = F.when(F.col("quantity") % 2 == 0, F.lit("abc")).otherwise(F.col("price"))
    return r.select(
        "event_id", fn.money(F.col("price")).alias("price"), fn.money(doubtful, "null").alias("price_or_null"),
        fn.ts_wallclock(F.col("updated_at")).alias("wallclock"), instant.cast("timestamp_ntz").alias("instant"),
        fn.unix_floor(instant).alias("unix_time"),
        fn.clamp_to(instant, limit).cast("timestamp_ntz").alias("clamped"),
        fn.published_when_active(status, F.col("created_at")).alias("published_at"),
        fn.grams(F.col("grams").cast("double")).alias("grams"), fn.money_text(F.col("grams")).alias("grams_text"),
        fn.millis_to_seconds(F.col("quantity").cast("double")).alias("thousandth"),
    )


# -- keys, uniqueness, quality -----------------------------------------------

@query("latest_by_key", f"""
SELECT * EXCLUDE rn FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, event_id DESC) AS rn FROM ({SQL_ORDER_DETAILS})
) WHERE rn = 1""")
def latest_order_details(t):
    return latest_by_key(ingest.to_order_details(a.raw_order_details(t)), ["id"], ["updated_at", "event_id"])


@query("unique_handle", r"""
SELECT seq, base, CASE WHEN rn = 1 THEN base ELSE base || '-' || CAST(rn - 1 AS VARCHAR) END AS handle
FROM (SELECT p_partkey AS seq, replace(p_name, ' ', '-') AS base,
             row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part)""")
def unique_handle(t):
    rows = t["part"].select(F.col("p_partkey").alias("seq"), fn.handle(F.col("p_name")).alias("base"))
    return handles.unique_handle(rows)


@query("unique_handle_taken", r"""
WITH RECURSIVE r AS (
  SELECT p_partkey AS seq, replace(p_name, ' ', '-') AS name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k,
         CASE WHEN p_partkey % 3 = 0 THEN replace(p_name, ' ', '-') || '-' || CAST(1 + p_partkey % 40 AS VARCHAR)
              ELSE replace(p_name, ' ', '-') END AS base FROM part),
s AS (
  SELECT k, name, seq, base, base AS handle, [base] AS used FROM r WHERE k = 1
  UNION ALL
  SELECT k, name, seq, base, handle, list_append(used, handle) FROM (
    SELECT r.k, r.name, r.seq, r.base, s.used,
           [x FOR x IN [CASE WHEN i = 0 THEN r.base ELSE r.base || '-' || CAST(i AS VARCHAR) END FOR i IN range(0, r.k + 1)]
            IF NOT list_contains(s.used, x)][1] AS handle
    FROM s JOIN r ON r.name = s.name AND r.k = s.k + 1))
SELECT seq, base, handle FROM s""")
def unique_handle_taken(t):
    """Bases that already look numbered and so collide with handed-out names."""
    base = fn.handle(F.col("p_name"))
    numbered = F.concat(base, F.lit("-"), (1 + F.col("p_partkey") % 40).cast("string"))
    rows = t["part"].select(
        F.col("p_partkey").alias("seq"), F.when(F.col("p_partkey") % 3 == 0, numbered).otherwise(base).alias("base")
    )
    return handles.unique_handle(rows)


@query("dedup_events", """
SELECT event_id, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY dedup_id ORDER BY event_id) AS rn FROM (
    SELECT event_id, user_id, event_type, CASE WHEN event_id % 9 > 0 THEN user_id || '-' || event_type END AS dedup_id FROM events)
) WHERE rn = 1 OR dedup_id IS NULL""")
def dedup_events_query(t):
    rows = t["events"].selectExpr(
        "event_id", "user_id", "event_type", "CASE WHEN event_id % 9 > 0 THEN user_id || '-' || event_type END AS dedup_id"
    )
    return dedup_events(rows, "dedup_id", ["event_id"]).drop("dedup_id")


@query("insert_unique", """
SELECT topic, "partition", "offset", event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY topic, "partition", "offset" ORDER BY event_id) AS rn FROM (
    SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id // 2 AS "offset", event_id, ts FROM events))
WHERE rn = 1 AND ts >= TIMESTAMP '2024-01-15 00:00:00' AND (topic, "partition", "offset") NOT IN (
  SELECT (event_type, CAST(user_id % 3 AS INTEGER), event_id // 2) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
UNION ALL SELECT NULL, NULL, NULL, NULL WHERE false""")
def insert_unique(t):
    """The second half of the events inserted into the first half's table, duplicates skipped."""
    rows = t["events"].selectExpr(
        "event_type AS topic", "cast(user_id % 3 as int) AS `partition`", "event_id div 2 AS offset", "event_id", "ts"
    )
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    out = insertable(
        rows.filter(F.col("ts") >= cut), rows.filter(F.col("ts") < cut), ["topic", "partition", "offset"], ["event_id"], "skip"
    )
    return out.drop("ts")


def dirty_lines(t):
    """Consumed order lines, some with blank titles, missing grams or unknown booleans."""
    return (
        ingest.to_consumed_order_details(enveloped(t))
        .withColumn("title", F.when(F.col("line_item_id") % 10 == 7, F.lit("  ")).otherwise(F.col("title")))
        .withColumn("grams", F.when(F.col("line_item_id") % 10 != 6, F.col("grams")))
        .withColumn("taxable", F.when(F.col("line_item_id") % 10 != 5, F.col("taxable")))
    )


@query("validate_rows", """
SELECT l_orderkey * 10 + l_linenumber AS line_item_id, l_partkey AS product_id, l_suppkey,
       CASE l_linenumber WHEN 7 THEN 'title is missing' WHEN 6 THEN 'grams is missing'
                         WHEN 5 THEN 'taxable is not true or false' ELSE '' END AS reasons
FROM lineitem""")
def validate_rows(t):
    checked = quality.with_reasons(dirty_lines(t), quality.ORDER_DETAIL_REQUIRED, quality.ORDER_DETAIL_BOOLEANS)
    return checked.select(
        "line_item_id", "product_id", F.regexp_extract("vendor", "([0-9]+)", 1).cast("bigint").alias("l_suppkey"),
        F.array_join("reasons", "; ").alias("reasons"),
    )


def framed_lines(t):
    """Order lines as framed JSON messages; some have a bad frame, an unknown schema id, a broken body or missing fields."""
    dirty = (
        enveloped(t)
        .withColumn("title", F.when(F.col("id") % 10 == 7, F.lit(" \t")).otherwise(F.col("title")))
        .withColumn("grams", F.when(F.col("id") % 10 != 6, F.col("grams")))
        .withColumn("taxable", F.when(F.col("id") % 10 != 5, F.col("taxable")))
    )
    fields = [c for c in a.raw_order_details(t).columns if c != "event_id"]
    body = F.when(F.col("id") % 19 == 0, F.lit("{")).otherwise(F.to_json(F.struct(*fields)))
    head = F.concat(
        F.when(F.col("id") % 13 == 0, F.lit("01")).otherwise(F.lit("00")), F.when(F.col("id") % 17 == 0, F.lit("00000009")).otherwise(F.lit("00000001")))
    return dirty.select(*ENVELOPE, "consumed_at", F.concat(F.unhex(head), F.encode(body, "UTF-8")).alias("value"))


@query("consume_validated", """
SELECT id * 1000 + l_partkey % 1000 AS "offset",
       CASE WHEN id % 13 = 0 THEN 'bad frame' WHEN id % 17 = 0 THEN 'unknown schema' WHEN id % 19 = 0 THEN 'undecodable body'
            WHEN l_linenumber = 7 THEN 'title is missing' WHEN l_linenumber = 6 THEN 'grams is missing'
            WHEN l_linenumber = 5 THEN 'taxable is not true or false' ELSE 'stored' END AS verdict
FROM (SELECT *, l_orderkey * 10 + l_linenumber AS id FROM lineitem)""")
def consume_validated(t):
    """The consumer's batch form: what is stored, and why the rest is not."""
    schema = a.raw_order_details(t).schema
    registry = t.spark.createDataFrame([(1, "order line")], "schema_id bigint, schema_json string")
    rows = consumer.judged(framed_lines(t), registry, consumer.json_record(schema), schema)
    return consumer.verdicts(rows).select("offset", "verdict")


# Frames by message number: a bad first byte, a schema id that is not registered, half a body; the rest is whole.
BROKEN = "CASE WHEN id % 13 = 0 THEN 'bad frame' WHEN id % 17 = 0 THEN 'unknown schema' WHEN id % 19 = 0 THEN 'undecodable body' END"


def framed_topic(rows, topic, number, *left_out):
    """Raw rows of a topic as framed JSON messages, broken in places; `left_out` are fields their writer does not know yet."""
    n = F.col(number)
    body = F.to_json(F.struct(*[c for c in rows.columns if c not in left_out]))
    head = F.concat(F.when(n % 13 == 0, F.lit("01")).otherwise(F.lit("00")), F.when(n % 17 == 0, F.lit("00000009")).otherwise(F.lit("00000001")))
    raw = F.concat(F.unhex(head), F.encode(F.when(n % 19 == 0, F.substring(body, 1, 12)).otherwise(body), "UTF-8"))
    return rows.select(F.lit(topic).alias("topic"), F.lit(0).alias("partition"), n.cast("bigint").alias("offset"), raw.alias("value"))


def judged_frames(t, topic, messages):
    known = t.spark.createDataFrame([(1, topic)], "schema_id bigint, schema_json string")
    return consumer.judged_topic(topic, messages, known, consumer.json_record(schemas.TOPIC_SCHEMAS[topic]))


def framed_goods(t):
    """Products whose every 11th has a variant price that is no amount."""
    raw = a.raw_products(t, dealt=True)
    spoiled = F.transform("variants", lambda v: v.withField("price", F.lit("n/a")))
    return framed_topic(raw.withColumn("variants", F.when(F.col("id") % 11 == 0, spoiled).otherwise(F.col("variants"))), "products", "id")


@query("ingest_framed_products", f"""
SELECT event_id, id, title, vendor, product_type, handle, status, tags, {wall('created_at')} AS created_at,
       {wall('updated_at')} AS updated_at, {wall('published_at')} AS published_at
FROM {GOODS} WHERE {BROKEN} IS NULL AND (id % 11 <> 0 OR id NOT IN (SELECT product_id FROM {VARIANTS}))""")
def ingest_framed_products(t):
    return consumer.ingested("products", judged_frames(t, "products", framed_goods(t)))["products"]


@query("ingest_framed_variants", f"SELECT * FROM ({SQL_PRODUCT_VARIANTS}) WHERE {BROKEN.replace('id %', 'product_id %')} IS NULL AND product_id % 11 <> 0")
def ingest_framed_variants(t):
    return consumer.ingested("products", judged_frames(t, "products", framed_goods(t)))["product_variants"]


@query("ingest_framed_customers", f"""
SELECT event_id, id, email, first_name, last_name, CAST(NULL AS VARCHAR) AS phone, state, verified_email, tags,
       {wall('created_at')} AS created_at, {wall('updated_at')} AS updated_at
FROM {PEOPLE} WHERE {BROKEN} IS NULL""")
def ingest_framed_customers(t):
    """Messages of a writer that has no telephone numbers yet, in today's shape."""
    messages = framed_topic(a.raw_customers(t, dealt=True), "customers", "id", "phone")
    return consumer.ingested("customers", judged_frames(t, "customers", messages))["customers"]


@query("ingest_framed_inventory", f"""
SELECT event_id, inventory_item_id, location_id, available, {wall('updated_at')} AS updated_at
FROM {LEVELS} WHERE {BROKEN.replace('id %', 'inventory_item_id %')} IS NULL""")
def ingest_framed_inventory(t):
    messages = framed_topic(a.raw_inventory(t), "inventory", "inventory_item_id")
    return consumer.ingested("inventory", judged_frames(t, "inventory", messages))["inventory_levels"]


@query("framed_rejects", f"""
SELECT 'products' AS topic, id AS "offset", coalesce({BROKEN}, 'a variant''s price is not an amount') AS reasons FROM {GOODS}
WHERE {BROKEN} IS NOT NULL OR (id % 11 = 0 AND id IN (SELECT product_id FROM {VARIANTS}))
UNION ALL SELECT 'customers', id, {BROKEN} FROM {PEOPLE} WHERE {BROKEN} IS NOT NULL""")
def framed_rejects(t):
    frames = {"products": framed_goods(t), "customers": framed_topic(a.raw_customers(t, dealt=True), "customers", "id")}
    parts = [consumer.rejected(judged_frames(t, topic, messages)) for topic, messages in frames.items()]
    return parts[0].unionByName(parts[1]).select("topic", "offset", F.array_join("reasons", "; ").alias("reasons"))


@query("quality_report", f"""
SELECT 'not_null' AS rule, 'available' AS "column", count(*) FILTER (available IS NULL) AS violations FROM {LEVELS}
UNION ALL SELECT 'not_null', 'updated_at', count(*) FILTER (updated_at IS NULL) FROM {LEVELS}
UNION ALL SELECT 'unique', 'event_id', count(event_id) - count(DISTINCT event_id) FROM {LEVELS}
UNION ALL SELECT 'unique', 'inventory_item_id', count(inventory_item_id) - count(DISTINCT inventory_item_id) FROM {LEVELS}""")
def quality_report(t):
    return quality.quality_report(
        a.raw_inventory(t), not_null=["available", "updated_at"], unique=["event_id", "inventory_item_id"]
    )


@query("unique_violations", """
SELECT p_name, count(*) AS n_rows FROM part GROUP BY 1 HAVING count(*) > 1""")
def unique_violations(t):
    return quality.unique_violations(t["part"], ["p_name"])


@query("unique_violations_key", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def unique_violations_key(t):
    return quality.unique_violations(t["lineitem"], ["l_orderkey", "l_linenumber"])


PRODUCT_CONTRACT = {
    "id": "BIGINT", "title": "STRING", "handle": "STRING", "status": "STRING", "tags": "STRING", "updated_at": "BIGINT",
}


@query("schema_drift", """
SELECT 'tags' AS field, 'STRING' AS expected, 'ARRAY' AS actual, count(*) AS n_rows FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT 'updated_at', 'BIGINT', 'STRING', 2 * count(*) FROM part
UNION ALL SELECT 'variants', NULL, 'ARRAY', 2 * count(*) FROM part""")
def schema_drift(t):
    """Product bodies against a contract that knows no tag lists, no text times and no variants."""
    return quality.body_drift(a.product_webhooks(t), PRODUCT_CONTRACT)


@query("evolve_schema", f"""
SELECT event_id, inventory_item_id, location_id, available, updated_at, NULL::VARCHAR AS source FROM {LEVELS}
UNION ALL SELECT NULL, inventory_item_id, location_id, available, updated_at, 'old' FROM {LEVELS}""")
def evolve_schema(t):
    """Rows of an older table generation (no `event_id`, other integer width) under the current ones."""
    from cartstream import schemas

    raw = a.raw_inventory(t)
    old = raw.drop("event_id").withColumn("location_id", F.col("location_id").cast("int")).withColumn("source", F.lit("old"))
    return tb.append_evolved([tb.evolve(raw, schemas.RAW_INVENTORY), tb.evolve(old, schemas.RAW_INVENTORY)])


@query("invariants", f"""
WITH v AS {VARIANTS}, p AS {GOODS}, i AS {LEVELS}
SELECT 'product_fields_present' AS "check", count(*) FILTER (title = '' OR handle = '' OR tags = '') AS violations FROM p
UNION ALL SELECT 'one_to_three_variants', (SELECT count(*) FROM part WHERE p_partkey % 10 < 2)
UNION ALL SELECT 'product_time_parses', count(*) FILTER (id % 50 = 7) FROM p
UNION ALL SELECT 'variant_sku_prefix', count(*) FILTER (sku NOT LIKE 'SKU-%') FROM v
UNION ALL SELECT 'variant_position_positive', count(*) FILTER (position < 1) FROM v
UNION ALL SELECT 'variant_parent_id', count(DISTINCT product_id) FILTER (product_id % 60 = 11) FROM v
UNION ALL SELECT 'available_present', count(*) FILTER (coalesce(available, -1) < 0) FROM i
UNION ALL SELECT 'location_in_range', count(*) FILTER (location_id NOT BETWEEN 1 AND 3) FROM i
UNION ALL SELECT 'level_time_parses', count(*) FILTER (inventory_item_id % 70 = 3) FROM i
UNION ALL SELECT 'product_id_unique', count(*) - count(DISTINCT id) FROM p
UNION ALL SELECT 'variant_id_unique', count(*) - count(DISTINCT id) FROM v
UNION ALL SELECT 'inventory_item_id_unique', count(*) - count(DISTINCT inventory_item_id) FROM v""")
def invariants(t):
    """Over events some of which have a bad time or a variant of another product."""
    products = a.raw_products(t).withColumn("created_at", F.when(F.col("id") % 50 == 7, "soon").otherwise(F.col("created_at")))
    strange = F.transform("variants", lambda v: v.withField("product_id", F.lit(0).cast("bigint")))
    products = products.withColumn("variants", F.when(F.col("id") % 60 == 11, strange).otherwise(F.col("variants")))
    levels = a.raw_inventory(t).withColumn("updated_at", F.when(F.col("inventory_item_id") % 70 == 3, "?").otherwise(F.col("updated_at")))
    return quality.invariants(products, levels)


# -- joins -------------------------------------------------------------------

def lookup(t):
    """One row per inventory item, with the raw grams the lake table does not keep."""
    rows = a.raw_products(t).select(F.explode("variants").alias("v")).select("v.*")
    rows = rows.withColumnRenamed("id", "variant_id").withColumn("updated_at", fn.ts_wallclock(F.col("updated_at")))
    return enrich.variant_lookup(rows)


@query("enrich_order_details", f"""
WITH l AS (SELECT event_id, order_id, title, variant_id AS item, price, grams, sku FROM {LINES}), v AS {VARIANTS}
SELECT l.item AS inventory_item_id, l.event_id, l.order_id, l.title, v.id AS variant_id, v.product_id,
       CASE WHEN v.id IS NULL THEN l.price ELSE v.price END AS price,
       CASE WHEN v.id IS NULL THEN l.grams ELSE v.grams END AS grams,
       CASE WHEN v.id IS NULL THEN l.sku ELSE v.sku END AS sku,
       coalesce(v.option1 || coalesce(' / ' || v.option2, ''), 'Default Title') AS variant_title,
       l.title || ' - ' || coalesce(v.option1 || coalesce(' / ' || v.option2, ''), 'Default Title') AS name,
       coalesce(v.inventory_management, 'shopify') AS variant_inventory_management
FROM l LEFT JOIN v ON v.inventory_item_id = l.item""")
def enrich_order_details(t):
    items = a.raw_order_details(t).select(
        F.col("variant_id").alias("inventory_item_id"), "event_id", "order_id", "title", "price", "grams", "sku"
    )
    return enrich.enrich_order_details(items, lookup(t))


@query("enrich_inventory", f"""
WITH i AS {LEVELS}, v AS {VARIANTS}
SELECT i.event_id, i.inventory_item_id, i.location_id, i.available, i.updated_at, v.sku, v.product_id, p.p_name AS product_title
FROM i LEFT JOIN v ON v.inventory_item_id = i.inventory_item_id LEFT JOIN part p ON p.p_partkey = v.product_id""")
def enrich_inventory(t):
    raw = a.raw_products(t)
    return enrich.enrich_inventory(a.raw_inventory(t), ingest.to_product_variants(raw), ingest.to_products(raw))


@query("known_keys", f"""
SELECT event_id, inventory_item_id FROM {LEVELS} WHERE inventory_item_id IN (SELECT inventory_item_id FROM {VARIANTS})""")
def known_keys(t):
    levels = a.raw_inventory(t).select("event_id", "inventory_item_id")
    return enrich.keep_known(levels, ingest.to_product_variants(a.raw_products(t)), "inventory_item_id").select(
        "event_id", "inventory_item_id")


@query("orphans", f"""
SELECT event_id, inventory_item_id FROM {LEVELS} WHERE inventory_item_id NOT IN (SELECT inventory_item_id FROM {VARIANTS})""")
def orphans(t):
    levels = a.raw_inventory(t).select("event_id", "inventory_item_id")
    return enrich.orphans(levels, ingest.to_product_variants(a.raw_products(t)), "inventory_item_id").select(
        "event_id", "inventory_item_id")


@query("fk_check", f"""
SELECT event_id, variant_id, verdict FROM (
  SELECT event_id, CASE WHEN quantity % 5 > 0 THEN variant_id END AS variant_id,
         CASE WHEN quantity % 5 = 0 OR variant_id IN (SELECT id FROM {VARIANTS}) THEN 'ok' ELSE 'rejected' END AS verdict
  FROM {LINES})""")
def fk_check(t):
    lines = a.raw_order_details(t).select(
        "event_id", F.when(F.col("quantity") % 5 > 0, F.col("variant_id")).alias("variant_id"))
    ok, bad = enrich.fk_check(lines, ingest.to_product_variants(a.raw_products(t)), "variant_id", "variant_id")
    cols = ["event_id", "variant_id"]
    return ok.select(*cols, F.lit("ok").alias("verdict")).unionByName(bad.select(*cols, F.lit("rejected").alias("verdict")))


@query("cascade_delete", f"""
SELECT id AS variant_id, product_id FROM {VARIANTS} WHERE product_id NOT IN (SELECT p_partkey FROM part WHERE p_size < 10)""")
def cascade_delete(t):
    variants = ingest.to_product_variants(a.raw_products(t)).select("variant_id", "product_id")
    deletes = t["part"].filter("p_size < 10").select(F.col("p_partkey").alias("id"))
    return enrich.cascade_delete(variants, deletes, "product_id").select("variant_id", "product_id")


@query("product_360", f"""
WITH v AS {VARIANTS}, l AS {LINES},
s AS (SELECT variant_id, count(*) AS n_lines, sum(quantity) AS units, sum({dec('price')} * quantity) AS revenue FROM l GROUP BY 1)
SELECT p_partkey AS product_id, p_name AS title, {a.STATUS} AS status, v.id AS variant_id, v.sku, {dec('v.price')} AS price,
       coalesce(s.n_lines, 0) AS n_lines, CAST(coalesce(s.units, 0) AS BIGINT) AS units,
       CAST(coalesce(s.revenue, 0) AS DECIMAL(28,2)) AS revenue
FROM part LEFT JOIN v ON v.product_id = p_partkey LEFT JOIN s ON s.variant_id = v.id""")
def product_360(t):
    raw = a.raw_products(t)
    return enrich.product_360(
        ingest.to_products(raw), ingest.to_product_variants(raw), ingest.to_order_details(a.raw_order_details(t))
    )


@query("product_lines", f"""
WITH l AS (SELECT *, (row_number() OVER (PARTITION BY product_id ORDER BY id, event_id) - 1) // 7 AS chunk FROM ({SQL_ORDER_DETAILS})),
c AS (SELECT product_id, chunk, count(*) AS n_lines, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id, event_id) AS ids, sum(quantity) AS units
      FROM l WHERE product_id IS NOT NULL GROUP BY ALL)
SELECT p_partkey AS product_id, coalesce(chunk, 0) AS chunk, coalesce(n_lines, 0) AS n_lines, coalesce(ids, '') AS ids,
       CAST(coalesce(units, 0) AS BIGINT) AS units
FROM part LEFT JOIN c ON c.product_id = p_partkey""")
def product_lines(t):
    chunks = enrich.product_lines(ingest.to_products(a.raw_products(t)), ingest.to_order_details(a.raw_order_details(t)), 7)
    line = F.transform("lines", lambda x: x["id"].cast("string"))
    units = F.aggregate("lines", F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x["quantity"], F.lit(0)))
    return chunks.select(
        "product_id", "chunk", F.size("lines").cast("bigint").alias("n_lines"), F.array_join(line, ",").alias("ids"), units.alias("units"))


@query("claimed_values", """
WITH RECURSIVE c AS (SELECT c_custkey AS k, c_custkey // 10 AS g FROM customer),
e AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY seq) AS n FROM (
  SELECT g, k * 4 AS seq, CAST(k AS VARCHAR) AS owner, 'v' || CAST(g AS VARCHAR) || '-' || CAST(k % 4 AS VARCHAR) AS value FROM c
  UNION ALL
  SELECT g, k * 4 + 13, CAST(k AS VARCHAR), CASE WHEN k % 3 > 0 THEN 'v' || CAST(g AS VARCHAR) || '-' || CAST((k + 1) % 6 AS VARCHAR) END FROM c)),
s AS (
  SELECT DISTINCT g, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS VARCHAR) AS value,
         TRUE AS granted, CAST([] AS STRUCT(o VARCHAR, v VARCHAR)[]) AS held FROM e
  UNION ALL
  SELECT g, n, seq, owner, value, granted,
         CASE WHEN granted THEN list_append([h FOR h IN held IF h.o <> owner], {'o': owner, 'v': value}) ELSE held END
  FROM (SELECT e.g, e.n, e.seq, e.owner, e.value, s.held,
               e.value IS NULL OR len([h FOR h IN s.held IF h.v = e.value AND h.o <> e.owner]) = 0 AS granted
        FROM s JOIN e ON e.g = s.g AND e.n = s.n + 1))
SELECT seq, owner, value, granted FROM s WHERE n > 0""")
def claimed_values(t):
    """Every customer asks for a value and later for another, or for none; some of these others hold, some were let go."""
    k, g = F.col("c_custkey"), F.floor(F.col("c_custkey") / 10).cast("string")
    named = lambda n: F.concat(F.lit("v"), g, F.lit("-"), n.cast("string"))
    asked = F.array(
        F.struct((k * 4).alias("seq"), named(k % 4).alias("value")),
        F.struct((k * 4 + 13).alias("seq"), F.when(k % 3 > 0, named((k + 1) % 6)).alias("value")),
    )
    rows = t["customer"].select(k.cast("string").alias("owner"), F.explode(asked).alias("_a")).select("_a.seq", "owner", "_a.value")
    return claims.grant(rows, None, ["seq"])
