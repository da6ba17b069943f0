"""Queries over landed webhooks: admission, deduplication, parsing, current state."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartstream import functions as fn
from cartstream import schemas
from cartstream.operators import explorer
from cartstream.operators import webhooks as wh
from cartstream.operators.upsert import upsert
from cartstream.plans import adapters as a
from cartstream.plans.registry import query
from cartstream.sources.topics import with_header_defaults

REQUESTS = f"({a.sql_frame(a.EVENT_WEBHOOKS, 'events')})"


def ntz(df, *names):
    """Instants as zone-less UTC times, for comparison across engines."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in names else c for c in df.columns])


@query("landed_webhooks", f"""
SELECT coalesce(webhook_id, 'unknown') AS webhook_id, coalesce(topic, 'unknown') AS topic, body, received_at, seq FROM {REQUESTS}""")
def landed_webhooks(t):
    return ntz(with_header_defaults(a.event_webhooks(t)), "received_at").select(
        "webhook_id", "topic", "body", "received_at", "seq")


@query("payload_hash", f"SELECT seq, sha256(body) AS payload_hash FROM {REQUESTS}")
def payload_hash(t):
    return a.event_webhooks(t).select("seq", fn.payload_hash(F.col("body")).alias("payload_hash"))


@query("verify_digest", f"SELECT seq, topic FROM {REQUESTS} WHERE seq % 5 > 0")
def verify_digest(t):
    return wh.verify_digest(a.event_webhooks(t), secret="s3cret").select("seq", "topic")


@query("json_split", f"""
SELECT seq, CASE WHEN seq % 5 = 0 THEN 'bad_digest' WHEN seq % 4 = 0 THEN 'bad_json' ELSE 'accepted' END AS verdict FROM {REQUESTS}""")
def json_split(t):
    return wh.admission(a.event_webhooks(t), secret="s3cret").select("seq", "verdict")


@query("webhook_rejects", """
SELECT p_partkey AS seq, CASE WHEN p_partkey % 10 = 0 THEN 'title is missing' WHEN p_partkey % 7 = 0 THEN 'created_at is not a time'
                              ELSE 'a nested time is not a time' END AS reason
FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0""")
def webhook_rejects(t):
    """Product bodies some of which lack the title, or have times that are none."""
    body = """'{"id": ' || p_partkey || if(p_partkey % 5 = 0, '', ', "title": "x"') || if(p_partkey % 7 = 0, ', "created_at": "soon"', '')
              || if(p_partkey % 11 = 0, ', "variants": [{"updated_at": "2024-01-01T00:00:00Z"}, {"updated_at": "never"}]', '') || '}'"""
    rows = t["part"].selectExpr(
        "p_partkey AS seq", "if(p_partkey % 2 = 0, 'products/create', 'products/update') AS topic", f"{body} AS body", "'' AS digest")
    return wh.screened(rows).filter("verdict != 'accepted'").select("seq", F.col("verdict").alias("reason"))


@query("from_json_body", f"""
SELECT seq, CASE WHEN json_valid(body) THEN CAST(json_extract_string(body, '$.k') AS INTEGER) END AS k FROM {REQUESTS}""")
def from_json_body(t):
    return a.event_webhooks(t).select("seq", F.from_json("body", "k int")["k"].alias("k"))


@query("dedup_payload", f"""
WITH seen AS (SELECT DISTINCT sha256(body) AS h FROM {REQUESTS} WHERE received_at < TIMESTAMP '2024-01-02 00:00:00')
SELECT payload_hash, seq FROM (
  SELECT sha256(body) AS payload_hash, seq, row_number() OVER (PARTITION BY sha256(body) ORDER BY seq) AS rn
  FROM {REQUESTS} WHERE received_at >= TIMESTAMP '2024-01-02 00:00:00')
WHERE rn = 1 AND payload_hash NOT IN (SELECT h FROM seen)""")
def dedup_payload(t):
    """Requests from the second day on against an audit of the first."""
    rows = a.event_webhooks(t)
    cut = F.lit("2024-01-02 00:00:00").cast("timestamp")
    audit = wh.to_audit(wh.dedup_in_batch(rows.filter(F.col("received_at") < cut), ("seq",)))
    return wh.dedup_payload(rows.filter(F.col("received_at") >= cut), audit, ("seq",)).select("payload_hash", "seq")


@query("audit_events", f"""
SELECT coalesce(webhook_id, 'unknown') AS source_id, coalesce(topic, 'unknown') AS topic,
       CASE WHEN topic LIKE 'products/%' THEN 'products' WHEN topic LIKE 'orders/%' THEN 'order_details'
            WHEN topic LIKE 'customers/%' THEN 'customers' WHEN topic LIKE 'inventory%' THEN 'inventory_levels'
            ELSE 'unknown' END AS table_name,
       CASE WHEN topic LIKE '%/create' THEN 'create' WHEN topic LIKE '%/update' THEN 'update' ELSE 'unknown' END AS operation,
       sha256(body) AS payload_hash, received_at AS created_at
FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY seq) AS rn FROM {REQUESTS}) WHERE rn = 1""")
def audit_events(t):
    return ntz(wh.to_audit(wh.dedup_in_batch(a.event_webhooks(t), ("seq",))), "created_at")


# -- state -------------------------------------------------------------------

LINE_ORDER = f"l_shipdate, 'w-' || {a.LINE_ID}"

# Line items of the order messages as rows, `item` their place in the message.
SQL_LINE_ITEMS = f"""(
SELECT CAST(l_orderkey * 10 + CASE WHEN item = 0 THEN l_linenumber ELSE 9 END AS VARCHAR) AS id, item,
       CAST(l_orderkey AS VARCHAR) AS order_id, CASE WHEN l_partkey % 7 > 0 THEN CAST(l_partkey AS VARCHAR) END AS product_id,
       CASE WHEN l_suppkey % 3 > 0 THEN CAST(l_partkey * 10 + 1 AS VARCHAR) END AS variant_id,
       'Part ' || CAST(l_partkey AS VARCHAR) AS title, CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity AS INTEGER) END AS quantity,
       CASE WHEN l_suppkey % 2 = 0 THEN CAST(CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(12,1)) AS DECIMAL(12,2)) AS VARCHAR)
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
       l_shipdate AS created_at,
       CASE WHEN l_linenumber <> 5 THEN date_trunc('day', l_shipdate) + INTERVAL 17 HOUR ELSE l_shipdate END AS updated_at,
       l_shipdate AS received_at, 'w-' || {a.LINE_ID} AS webhook_id
FROM lineitem JOIN (VALUES (0), (1)) AS n(item) ON item = 0 OR l_linenumber = 1)"""


@query("webhook_line_items", f"""
SELECT id, item, order_id, product_id, variant_id, title, quantity, price, updated_at, webhook_id FROM {SQL_LINE_ITEMS}""")
def webhook_line_items(t):
    out = wh.line_item_changes(a.order_webhooks(t))
    return ntz(out, "updated_at").select(
        "id", "item", "order_id", "product_id", "variant_id", "title", "quantity", "price", "updated_at", "webhook_id")


SQL_VARIANT_ROWS = """(
SELECT CAST(p_partkey * 10 + i AS VARCHAR) AS id, i - 1 AS item, CAST(p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_partkey % 2 = 0 THEN CAST(100 * k + i AS VARCHAR) || '.50' ELSE CAST(100 * k + i AS VARCHAR) || '.25' END AS price,
       CASE WHEN p_partkey % 3 = k THEN NULL ELSE 'S-' || CAST(p_partkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) || '-' || CAST(k AS VARCHAR) END AS sku,
       TIMESTAMP '2024-01-01 00:00:00' + (k - 1) * INTERVAL 1 DAY AS created_at,
       TIMESTAMP '2024-03-01 00:00:00' + (k - 1) * INTERVAL 1 DAY AS updated_at, k
FROM part, (VALUES (1), (2)) AS rounds(k), (VALUES (1), (2)) AS n(i))"""


@query("webhook_variants", f"SELECT id, item, product_id, price, sku, created_at, updated_at FROM {SQL_VARIANT_ROWS}")
def webhook_variants(t):
    out = wh.variant_changes(a.product_webhooks(t))
    return ntz(out, "created_at", "updated_at").select("id", "item", "product_id", "price", "sku", "created_at", "updated_at")


def state(t, table, landed):
    return ntz(upsert(wh.STATE_CHANGES[table](landed), wh.STATE_SPECS[table]), "created_at", "updated_at")


@query("upsert_products", f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 6 = 0 THEN p_name || ' 1' ELSE p_name || ' 2' END AS title,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE replace(p_name, ' ', '-') END AS handle,
       CASE WHEN p_partkey % 5 = 0 THEN 'active' ELSE {a.STATUS} END AS status,
       CASE WHEN p_partkey % 2 = 0 THEN 'a,b' WHEN p_partkey % 3 = 0 THEN '' ELSE lower(p_type) END AS tags,
       TIMESTAMP '2024-03-01 00:00:00' AS created_at, TIMESTAMP '2024-02-02 05:00:00' AS updated_at
FROM part""")
def upsert_products(t):
    return state(t, "products", a.product_webhooks(t))


@query("upsert_variants", f"""
SELECT n.id, f.product_id, n.price, n.sku, f.created_at, n.updated_at
FROM {SQL_VARIANT_ROWS} n JOIN {SQL_VARIANT_ROWS} f ON f.id = n.id AND f.k = 1 WHERE n.k = 2""")
def upsert_variants(t):
    return state(t, "product_variants", a.product_webhooks(t))


@query("upsert_inventory", f"""
SELECT CAST(l_partkey AS VARCHAR) || ':' || CAST(1 + l_suppkey % 3 AS VARCHAR) AS id, CAST(l_partkey AS VARCHAR) AS inventory_item_id,
       CAST(1 + l_suppkey % 3 AS VARCHAR) AS location_id, CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS available,
       date_trunc('day', l_shipdate) + INTERVAL 8 HOUR AS updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey % 3 ORDER BY l_shipdate DESC, 'w-' || {a.LINE_ID} DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def upsert_inventory(t):
    return state(t, "inventory_levels", a.inventory_webhooks(t))


SQL_UPSERT_LINES = f"""
WITH c AS {SQL_LINE_ITEMS},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY received_at, webhook_id, item) AS seq FROM c)
SELECT id, arg_max(order_id, seq) AS order_id,
       arg_max(product_id, seq) FILTER (product_id IS NOT NULL) AS product_id,
       arg_max(variant_id, seq) FILTER (variant_id IS NOT NULL) AS variant_id,
       arg_min(title, seq) AS title,
       coalesce(arg_max(quantity, seq) FILTER (quantity IS NOT NULL), 1) AS quantity,
       arg_max(price, seq) AS price, arg_min(created_at, seq) AS created_at, arg_max(updated_at, seq) AS updated_at
FROM r GROUP BY id"""


@query("upsert_order_details", SQL_UPSERT_LINES)
def upsert_order_details(t):
    return state(t, "order_details", a.order_webhooks(t))


@query("upsert_order_details_merged", SQL_UPSERT_LINES)
def upsert_order_details_merged(t):
    """The same state from three batches folded on their own, then merged (in no particular order)."""
    from cartstream.operators.upsert import finalize, fold, merge

    changes = wh.line_item_changes(a.order_webhooks(t))
    spec = wh.STATE_SPECS["order_details"]
    batch = F.year("received_at") % 3
    folds = [fold(changes.filter(batch == k), spec) for k in (2, 0, 1)]
    return ntz(finalize(merge(folds, spec), spec), "created_at", "updated_at")


@query("upsert_customers", """
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 3 = 2 THEN 'm2.' ELSE 'm1.' END || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       substr(c_name, 1, 8) AS first_name, NULL::VARCHAR AS last_name,
       CASE WHEN c_custkey % 4 = 2 THEN '+1-' ELSE '+2-' END || CAST(c_custkey AS VARCHAR) AS phone,
       CASE WHEN c_custkey % 5 = 2 THEN 'enabled' ELSE 'disabled' END AS state, c_custkey % 2 = 1 AS verified_email,
       lower(c_mktsegment) || ',2' AS tags, TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-03-02 00:00:00' AS updated_at
FROM customer""")
def upsert_customers(t):
    return state(t, "customers", a.customer_webhooks(t))


# -- reading state and audit -------------------------------------------------

@query("recent_events", f"SELECT seq, topic, received_at FROM {REQUESTS} ORDER BY received_at DESC, seq LIMIT 50")
def recent_events(t):
    rows = a.event_webhooks(t).select("seq", "topic", "received_at")
    return ntz(explorer.recent_events(rows, 50, "received_at", "seq"), "received_at")


@query("last_event", f"SELECT seq, received_at FROM {REQUESTS} ORDER BY received_at DESC, seq LIMIT 1")
def last_event(t):
    return ntz(explorer.last_event(a.event_webhooks(t).select("seq", "received_at"), "received_at", "seq"), "received_at")


@query("event_health", """
SELECT count(*) AS total, CAST(floor(epoch(max(ts))) AS BIGINT) AS last_event_unix, max(ts) IS NOT NULL AS healthy FROM events""")
def event_health(t):
    return explorer.event_health(t["events"], "ts")


@query("event_health_empty", """
SELECT count(*) AS total, CAST(coalesce(floor(epoch(max(ts))), 0) AS BIGINT) AS last_event_unix, max(ts) IS NOT NULL AS healthy
FROM events WHERE event_type = 'none'""")
def event_health_empty(t):
    return explorer.event_health(t["events"].filter("event_type = 'none'"), "ts")


assert set(wh.STATE_SPECS) == set(wh.STATE_CHANGES) and schemas.AUDIT
