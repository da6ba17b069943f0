"""Commerce event frames derived from the generic test tables, row by row.

Each frame is a projection of one table (no shuffle, grows with the table). The
expressions are plain SQL text that both engines understand, so the SQL
counterparts select from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream import schemas
from cartstream.plans.registry import Tables


def s(expr: str) -> str:
    return f"cast({expr} as string)"


def select_list(fields: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in fields.items()]


def sql_frame(fields: dict[str, str], table: str) -> str:
    """The frame as SQL text."""
    return f"SELECT {', '.join(select_list(fields))} FROM {table}"


LINE_ID = f"{s('l_orderkey')} || '-' || {s('l_linenumber')} || '-' || {s('l_partkey')} || '-' || {s('l_suppkey')}"
SHIP_DAY = s("cast(l_shipdate as date)")
ITEM_ID = "l_partkey * 10 + 1 + l_suppkey % 4"

ORDER_DETAILS = {
    "event_id": f"'e-' || {LINE_ID}",
    "order_id": "l_orderkey",
    "id": "l_orderkey * 10 + l_linenumber",
    "variant_id": ITEM_ID,
    "product_id": "l_partkey",
    "title": f"'Line ' || {s('l_linenumber')}",
    "variant_title": "'Default Title'",
    "name": f"'Line ' || {s('l_linenumber')} || ' - Default Title'",
    "sku": f"'SKU-' || {s('l_partkey')} || '-' || {s(ITEM_ID)}",
    "vendor": f"'Supplier ' || {s('l_suppkey')}",
    "quantity": "cast(l_quantity as int)",
    "fulfillable_quantity": "cast(l_quantity as int)",
    "current_quantity": "cast(l_quantity as int)",
    "price": s("cast(l_extendedprice as decimal(12,2))"),
    "total_discount": s("cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))"),
    "fulfillment_service": "'manual'",
    "fulfillment_status": "CASE WHEN l_linestatus = 'F' THEN 'fulfilled' END",
    "grams": "cast(100 + l_suppkey % 900 as int)",
    "requires_shipping": "l_returnflag <> 'R'",
    "taxable": "l_tax > 0",
    "gift_card": "false",
    "product_exists": "true",
    "variant_inventory_management": "'shopify'",
    "created_at": f"{SHIP_DAY} || 'T10:30:00Z'",
    "updated_at": f"{SHIP_DAY} || 'T21:45:10-05:00'",
}

INVENTORY = {
    "event_id": f"'i-' || {LINE_ID}",
    "inventory_item_id": ITEM_ID,
    "location_id": "1 + l_suppkey % 3",
    "available": "CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_quantity as int) END",
    "updated_at": f"{SHIP_DAY} || 'T08:00:00Z'",
}

CUSTOMERS = {
    "event_id": f"'c-' || {s('c_custkey')}",
    "id": "c_custkey",
    "email": "lower(replace(c_name, '#', '.')) || '@example.com'",
    "first_name": "substr(c_name, 1, 8)",
    "last_name": "substr(c_name, 10)",
    "phone": f"CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '+1-555-' || {s('c_custkey')} END",
    "state": "CASE WHEN c_custkey % 5 = 3 THEN 'disabled' WHEN c_custkey % 5 = 4 THEN 'pending' ELSE 'enabled' END",
    "verified_email": "c_acctbal > 0",
    "tags": "lower(c_mktsegment) || ', nation-' || " + s("c_nationkey"),
    "created_at": f"'2024-0' || {s('1 + c_custkey % 9')} || '-1' || {s('c_custkey % 10')} || 'T06:00:00Z'",
    "updated_at": f"'2024-0' || {s('1 + c_custkey % 9')} || '-2' || {s('c_custkey % 9')} || 'T06:00:00Z'",
}

PRODUCT_DAY = f"'2024-0' || {s('1 + p_partkey % 9')} || '-1' || {s('p_partkey % 10')}"
STATUS = "CASE WHEN p_partkey % 5 = 3 THEN 'draft' WHEN p_partkey % 5 = 4 THEN 'archived' ELSE 'active' END"

PRODUCTS = {
    "event_id": f"'p-' || {s('p_partkey')}",
    "id": "p_partkey",
    "title": "p_name",
    "body_html": "'<p>' || p_name || '</p>'",
    "vendor": "p_brand",
    "product_type": "p_type",
    "handle": "replace(p_name, ' ', '-')",
    "status": STATUS,
    "tags": "lower(p_type) || ', ' || lower(replace(p_brand, '#', '-'))",
    "created_at": f"{PRODUCT_DAY} || 'T0' || {s('p_partkey % 8')} || ':30:00Z'",
    "updated_at": f"{PRODUCT_DAY} || 'T1' || {s('p_partkey % 8')} || ':30:00-05:00'",
    "published_at": f"CASE WHEN p_partkey % 5 < 3 THEN {PRODUCT_DAY} || 'T23:59:59Z' END",
}

# One variant, by the part's columns and the variant's number `i`.
PRICE = "cast(p_retailprice as decimal(10,2)) + cast(i as decimal(3,0)) * 0.255"
VARIANT = {
    "event_id": f"CASE WHEN i = 2 THEN 'v-' || {s('p_partkey')} END",
    "id": "p_partkey * 10 + i",
    "product_id": "p_partkey",
    "title": f"'Size ' || {s('i')}",
    "price": s(PRICE),
    "sku": f"'SKU-' || {s('p_partkey')} || '-' || {s('p_partkey * 10 + i')}",
    "position": "cast(i as int)",
    "inventory_policy": "CASE WHEN p_partkey % 2 = 0 THEN 'deny' ELSE 'continue' END",
    "compare_at_price": f"CASE WHEN i > 1 THEN {s(PRICE)} END",
    "fulfillment_service": "'manual'",
    "inventory_management": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'shopify' END",
    "option1": f"CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 'Size ' || {s('i')} END",
    "option2": "CASE WHEN p_partkey % 6 = 0 OR i = 1 THEN NULL ELSE p_type END",
    "option3": "cast(NULL as string)",
    "taxable": "true",
    "barcode": f"CASE WHEN i = 3 THEN lpad({s('p_partkey')}, 12, '0') END",
    "grams": "cast(100 * i + p_size as int)",
    "weight": "p_size * 0.25",
    "weight_unit": "'lb'",
    "inventory_item_id": "p_partkey * 10 + i",
    "inventory_quantity": "cast(p_size * i as int)",
    "requires_shipping": "true",
    "created_at": f"{PRODUCT_DAY} || 'T0' || {s('i')} || ':00:00Z'",
    "updated_at": f"{PRODUCT_DAY} || 'T0' || {s('i')} || ':30:00Z'",
}
N_VARIANTS = "CASE WHEN p_partkey % 10 < 2 THEN 0 ELSE 1 + p_partkey % 3 END"

# Products numbered ...0 have no list, ...1 an empty one, the others 1 to 3 variants.
SQL_VARIANTS = (
    f"SELECT {', '.join(select_list(VARIANT))} FROM part JOIN (VALUES (1), (2), (3)) AS n(i) ON i <= {N_VARIANTS}"
)


def raw_order_details(t: Tables) -> DataFrame:
    return t["lineitem"].selectExpr(*select_list(ORDER_DETAILS))


def raw_inventory(t: Tables) -> DataFrame:
    return t["lineitem"].selectExpr(*select_list(INVENTORY))


def _dealt(t: Tables, table: str, *key: str) -> DataFrame:
    """A table's rows as a topic of many partitions has them; the test tables are small files, which one task would read."""
    return t[table].repartition(*key)


def raw_customers(t: Tables, dealt: bool = False) -> DataFrame:
    rows = _dealt(t, "customer", "c_custkey") if dealt else t["customer"]
    return rows.selectExpr(*select_list(CUSTOMERS))


def raw_products(t: Tables, dealt: bool = False) -> DataFrame:
    one = ", ".join(f"'{n}', {e}" for n, e in VARIANT.items())
    variants = (
        f"CASE WHEN p_partkey % 10 > 0 THEN slice(transform(sequence(1, 3), i -> named_struct({one})), 1, "
        f"cast({N_VARIANTS} as int)) END AS variants"
    )
    rows = _dealt(t, "part", "p_partkey") if dealt else t["part"]
    out = rows.selectExpr(*select_list(PRODUCTS), variants)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW_PRODUCTS])


# -- landed webhooks ---------------------------------------------------------
# Bodies are JSON text put together from columns. `received_at` and `webhook_id`
# give a total arrival order.

TOPIC_BY_EVENT = (
    "CASE event_type WHEN 'view' THEN 'products/update' WHEN 'purchase' THEN 'orders/create' "
    "WHEN 'signup' THEN 'customers/create' WHEN 'click' THEN 'inventory_levels/update' ELSE 'foo/bar' END"
)

# Every fourth body is cut off, every fifth digest is wrong, every seventh has no webhook id.
EVENT_WEBHOOKS = {
    "webhook_id": f"CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'w-' || {s('event_id')} END",
    "topic": f"CASE WHEN event_id % 11 = 0 THEN NULL ELSE {TOPIC_BY_EVENT} END",
    "body": "CASE WHEN event_id % 4 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END",
    "received_at": "ts",
    "seq": "event_id",
}


def event_webhooks(t: Tables) -> DataFrame:
    rows = t["events"].selectExpr(*select_list(EVENT_WEBHOOKS), "event_type AS shop")
    digest = "CASE WHEN seq % 5 = 0 THEN 'wrong' ELSE sha2(body, 256) END AS digest"
    return rows.selectExpr("*", digest).withColumn("received_at", F.col("received_at").cast("timestamp"))


def _json(**fields: str) -> str:
    """SQL text that builds a JSON object; values are SQL expressions giving JSON text."""
    parts = " || ', ' || ".join(f"'\"{k}\": ' || {v}" for k, v in fields.items())
    return f"'{{' || {parts} || '}}'"


def _text(expr: str) -> str:
    return f"'\"' || {expr} || '\"'"


def _maybe(condition: str, value: str, other: str = "'null'") -> str:
    return f"CASE WHEN {condition} THEN {value} ELSE {other} END"


ORDER_PRICE_TEXT = s("cast(l_extendedprice as decimal(12,2))")
ORDER_PRICE_NUMBER = s("cast(cast(l_extendedprice as decimal(12,2)) as decimal(12,1))")


def _order_item(number: str) -> str:
    return _json(
        id=s(f"l_orderkey * 10 + {number}"),
        product_id=_maybe("l_partkey % 7 > 0", s("l_partkey")),
        variant_id=_maybe("l_suppkey % 3 > 0", s("l_partkey * 10 + 1"), "'0'"),
        title=_text(f"'Part ' || {s('l_partkey')}"),
        quantity=_maybe("l_linenumber <> 3", s("cast(l_quantity as int)")),
        price=_maybe("l_suppkey % 2 = 0", ORDER_PRICE_NUMBER, _text(ORDER_PRICE_TEXT)),
        updated_at=_maybe("l_linenumber <> 5", _text(f"{SHIP_DAY} || 'T12:00:00-05:00'"), "'\"\"'"),
    )


def order_webhooks(t: Tables) -> DataFrame:
    """One order message per line item; first lines carry a second item, number 9."""
    items = f"{_order_item('l_linenumber')} || CASE WHEN l_linenumber = 1 THEN ', ' || {_order_item('9')} ELSE '' END"
    return _dealt(t, "lineitem", "l_orderkey", "l_linenumber").selectExpr(
        f"'w-' || {LINE_ID} AS webhook_id",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'orders/updated' ELSE 'orders/create' END AS topic",
        f"'{{\"id\": ' || {s('l_orderkey')} || ', \"line_items\": [' || {items} || ']}}' AS body",
        "cast(l_shipdate as timestamp) AS received_at",
    )


def inventory_webhooks(t: Tables) -> DataFrame:
    body = _json(
        inventory_item_id=s("l_partkey"), location_id=s("1 + l_suppkey % 3"),
        available=_maybe("l_linenumber <> 7", s("cast(l_quantity as int)")),
        updated_at=_text(f"{SHIP_DAY} || 'T08:00:00Z'"),
    )
    return _dealt(t, "lineitem", "l_orderkey", "l_linenumber").selectExpr(
        f"'w-' || {LINE_ID} AS webhook_id", "'inventory_levels/update' AS topic", f"{body} AS body",
        "cast(l_shipdate as timestamp) AS received_at",
    )


PRODUCT_ROUNDS = {1: "products/create", 2: "products/update"}


def product_webhooks(t: Tables) -> DataFrame:
    """A create and an update per part. Updates may lack the title, empty the handle, send tags as a list."""
    def variant(i: int, k: int) -> str:
        return _json(
            id=s(f"p_partkey * 10 + {i}"),
            price=_maybe("p_partkey % 2 = 0", f"'{100 * k + i}.5'", _text(f"'{100 * k + i}.25'")),
            sku=_maybe(f"p_partkey % 3 = {k}", "'\"\"'", _text(f"'S-' || {s('p_partkey')} || '-{i}-{k}'")),
            created_at=_text(f"'2024-01-0{k}T00:00:00Z'"),
        )

    def body(k: int) -> str:
        fields = dict(
            id=s("p_partkey"),
            title=_maybe(f"p_partkey % 6 = 0 AND {k} = 2", "'null'", _text(f"p_name || ' {k}'")),
            handle=_maybe(f"p_partkey % 4 = 0 AND {k} = 2", "'\"\"'", _text("replace(p_name, ' ', '-')")),
            status=_maybe("p_partkey % 5 = 0", "'null'", _text(STATUS)),
            tags=_maybe(f"p_partkey % 2 = 0 AND {k} = 2", "'[\"a\", \"b\"]'", _maybe(
                "p_partkey % 3 = 0", "'null'", _text("lower(p_type)"))),
            updated_at=_text(f"'2024-02-0{k}T05:00:00Z'"),
            variants=f"'[' || {variant(1, k)} || ', ' || {variant(2, k)} || ']'",
        )
        return _json(**fields)

    rounds = [
        t["part"].selectExpr(
            f"'w-{k}-' || {s('p_partkey')} AS webhook_id", f"'{topic}' AS topic", f"{body(k)} AS body",
            f"cast('2024-03-0{k} 00:00:00' as timestamp) AS received_at",
        )
        for k, topic in PRODUCT_ROUNDS.items()
    ]
    return rounds[0].unionByName(rounds[1])


def customer_webhooks(t: Tables) -> DataFrame:
    """A create and an update per customer; updates leave out or empty contact fields."""
    def body(k: int) -> str:
        return _json(
            id=s("c_custkey"),
            email=_maybe(f"{k} = 2 AND c_custkey % 3 = 0", "'\"\"'", _maybe(
                f"{k} = 2 AND c_custkey % 3 = 1", "'null'", _text(f"'m{k}.' || {s('c_custkey')} || '@example.com'"))),
            first_name=_text("substr(c_name, 1, 8)"),
            phone=_maybe(f"c_custkey % 4 = {k}", "'null'", _text(f"'+{k}-' || {s('c_custkey')}")),
            state=_maybe(f"c_custkey % 5 = {k}", "'null'", _text("'disabled'")),
            verified_email=_maybe(f"c_custkey % 2 = {k - 1}", "'true'", "'null'"),
            tags=_text(f"lower(c_mktsegment) || ',{k}'"),
            created_at=_text(f"'2024-01-0{k}T00:00:00Z'"),
        )

    rounds = [
        t["customer"].selectExpr(
            f"'w-{k}-' || {s('c_custkey')} AS webhook_id",
            f"'customers/{'create' if k == 1 else 'update'}' AS topic", f"{body(k)} AS body",
            f"cast('2024-03-0{k} 00:00:00' as timestamp) AS received_at",
        )
        for k in (1, 2)
    ]
    return rounds[0].unionByName(rounds[1])


# -- samples, offsets, snapshots, files --------------------------------------

SAMPLES = {
    "ts": "ts",
    "event_id": "event_id",
    "metric": "CASE WHEN user_id % 2 = 0 THEN 'events_produced_total' ELSE 'events_consumed_total' END",
    "topic": "'shopify.' || event_type",
    "host": f"'host-' || {s('user_id % 3')}",
    # Ids grow with time, so this is a counter that restarts every 500 events.
    "counter": "cast(event_id % 500 as double)",
    "gauge": "cast(round(value * 100) as double)",
}


def flat_samples(t: Tables) -> DataFrame:
    return t["events"].selectExpr(*select_list(SAMPLES))


def samples(t: Tables, value: str = "counter") -> DataFrame:
    """The declared sample shape, labels in a map."""
    return flat_samples(t).selectExpr(
        "ts", "metric", "map('topic', topic, 'host', host) AS labels", f"{value} AS value"
    )


OFFSETS = {
    "group_id": "'group-' || " + s("user_id % 2"),
    "topic": "'shopify.' || event_type",
    "part": "cast(user_id % 3 as int)",
    "position": "event_id",
}

SNAPSHOTS = {"table_name": "event_type", "snapshot_id": "event_id", "committed_at": "ts"}

FILES = {
    "table_name": "event_type",
    "part": f"'location_id=' || {s('user_id % 3')}",
    "file_path": f"'f-' || lpad({s('event_id')}, 20, '0')",
    "size_bytes": "cast(round(value * 100) as bigint) * 10000",
}
