"""What a webhook topic means: target table, operation, metric type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topic to state table.
TOPIC_TABLES = {
    "products/create": "products",
    "products/update": "products",
    "products/delete": "products",
    "product_variants/create": "product_variants",
    "product_variants/update": "product_variants",
    "product_variants/delete": "product_variants",
    "inventory_levels/update": "inventory_levels",
    "orders/create": "order_details",
    "orders/updated": "order_details",
    "orders/delete": "order_details",
    "customers/create": "customers",
    "customers/update": "customers",
    "customers/delete": "customers",
}


def topics_of(table: str) -> list[str]:
    return [t for t, name in TOPIC_TABLES.items() if name == table]


def topic_table(topic: Column) -> Column:
    """State table of a topic, 'unknown' for any other topic."""
    out = F.lit("unknown")
    for table in sorted(set(TOPIC_TABLES.values())):
        out = F.when(topic.isin(topics_of(table)), F.lit(table)).otherwise(out)
    return out


def topic_operation(topic: Column) -> Column:
    """create / update / delete by the topic's suffix, else unknown."""
    return (
        F.when(topic.endswith("/create"), "create")
        .when(topic.endswith("/update") | topic.endswith("/updated"), "update")
        .when(topic.endswith("/delete"), "delete")
        .otherwise("unknown")
    )


def topic_type(topic: Column) -> Column:
    """First path segment without one trailing 's': 'products/create' is 'product'."""
    return F.regexp_replace(F.split_part(topic, F.lit("/"), F.lit(1)), "s$", "")
