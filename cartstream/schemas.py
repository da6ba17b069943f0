"""Declared schemas. Streams never infer: every source is read with one of these.

Fixed values: the names and types of wire and table columns, in their order.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "binary": T.BinaryType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "decimal(10,2)": T.DecimalType(10, 2),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def table(text: str, **nested: T.DataType) -> T.StructType:
    """'name type, name type, ...' as a schema; needs no running session, unlike `fromDDL`."""
    pairs = [p.strip().split(" ", 1) for p in text.split(", ")]
    fields = [T.StructField(n, _TYPES[t]) for n, t in pairs]
    return T.StructType(fields + [T.StructField(n, t) for n, t in nested.items()])


VARIANT_FIELDS = (
    "event_id string, id bigint, product_id bigint, title string, price string, sku string, "
    "position int, inventory_policy string, compare_at_price string, fulfillment_service string, "
    "inventory_management string, option1 string, option2 string, option3 string, taxable boolean, "
    "barcode string, grams int, weight double, weight_unit string, inventory_item_id bigint, "
    "inventory_quantity int, requires_shipping boolean, created_at string, updated_at string"
)


RAW_PRODUCTS = table(
    "event_id string, id bigint, title string, body_html string, vendor string, product_type string, "
    "handle string, status string, tags string, created_at string, updated_at string, "
    "published_at string",
    variants=T.ArrayType(table(VARIANT_FIELDS)),
)

RAW_ORDER_DETAILS = table(
    "event_id string, order_id bigint, id bigint, variant_id bigint, product_id bigint, title string, "
    "variant_title string, name string, sku string, vendor string, quantity int, "
    "fulfillable_quantity int, current_quantity int, price string, total_discount string, "
    "fulfillment_service string, fulfillment_status string, grams int, requires_shipping boolean, "
    "taxable boolean, gift_card boolean, product_exists boolean, variant_inventory_management string, "
    "created_at string, updated_at string"
)

RAW_INVENTORY = table(
    "event_id string, inventory_item_id bigint, location_id bigint, available int, updated_at string"
)

RAW_CUSTOMERS = table(
    "event_id string, id bigint, email string, first_name string, last_name string, phone string, "
    "state string, verified_email boolean, tags string, created_at string, updated_at string"
)

TOPIC_SCHEMAS = {
    "products": RAW_PRODUCTS,
    "order_details": RAW_ORDER_DETAILS,
    "inventory": RAW_INVENTORY,
    "customers": RAW_CUSTOMERS,
}

# Message key column per topic.
TOPIC_KEYS = {
    "products": "id",
    "order_details": "order_id",
    "inventory": "inventory_item_id",
    "customers": "id",
}

LAKE_PRODUCTS = table(
    "event_id string, id bigint, title string, vendor string, product_type string, handle string, "
    "status string, tags string, created_at timestamp_ntz, updated_at timestamp_ntz, "
    "published_at timestamp_ntz"
)

LAKE_VARIANTS = table(
    "event_id string, product_id bigint, variant_id bigint, title string, price decimal(10,2), "
    "sku string, position int, inventory_policy string, compare_at_price decimal(10,2), "
    "fulfillment_service string, inventory_management string, option1 string, option2 string, "
    "option3 string, taxable boolean, barcode string, weight double, weight_unit string, "
    "inventory_item_id bigint, inventory_quantity int, requires_shipping boolean, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)

LAKE_INVENTORY = table(
    "event_id string, inventory_item_id bigint, location_id bigint, available int, "
    "updated_at timestamp_ntz"
)

LAKE_ORDER_DETAILS = table(
    "event_id string, order_id bigint, id bigint, variant_id bigint, product_id bigint, title string, "
    "variant_title string, name string, sku string, vendor string, quantity int, "
    "fulfillable_quantity int, current_quantity int, price decimal(10,2), total_discount decimal(10,2), "
    "fulfillment_service string, fulfillment_status string, requires_shipping boolean, "
    "taxable boolean, gift_card boolean, product_exists boolean, variant_inventory_management string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)

LAKE_CUSTOMERS = table(
    "event_id string, id bigint, email string, first_name string, last_name string, phone string, "
    "state string, verified_email boolean, tags string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz"
)

LAKE_TABLES = {
    "products": LAKE_PRODUCTS,
    "product_variants": LAKE_VARIANTS,
    "inventory_levels": LAKE_INVENTORY,
    "order_details": LAKE_ORDER_DETAILS,
    "customers": LAKE_CUSTOMERS,
}

LAKE_PARTITIONS = {"inventory_levels": ["location_id"]}

# A landed webhook request: headers plus the raw body text.
LANDED_WEBHOOK = table(
    "webhook_id string, topic string, digest string, shop string, body string, received_at timestamp"
)

AUDIT = table(
    "source_id string, topic string, table_name string, operation string, payload_hash string, "
    "created_at timestamp"
)

# Body schemas. Ids are read as text (number text is kept exactly); fields that
# arrive either as a number or text, or as a list or text, are read as variants.
BODY_PRODUCT = (
    "id string, title string, handle string, status string, tags variant, created_at string, "
    "updated_at string, variants array<struct<id: string, price: variant, sku: string, "
    "created_at: string, updated_at: string>>"
)
BODY_INVENTORY = "inventory_item_id string, location_id string, available int, updated_at string"
BODY_ORDER = (
    "id string, line_items array<struct<id: string, variant_id: string, product_id: string, "
    "title: string, quantity: int, price: variant, created_at: string, updated_at: string>>"
)
BODY_CUSTOMER = (
    "id string, email string, first_name string, last_name string, phone string, state string, "
    "verified_email boolean, tags variant, created_at string, updated_at string"
)

SAMPLES = table("ts timestamp, metric string, labels map<string,string>, value double")

KAFKA_RECORD = table(
    "topic string, partition int, offset bigint, key binary, value binary, timestamp timestamp"
)
