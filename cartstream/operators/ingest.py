"""Raw event frames to append-only lake tables: plain projections and one explode.

Everything here is a narrow transformation, so a batch and a stream share the
same functions and no operator shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.functions import event_key, money, ts_instant, ts_wallclock


# The output columns of each table, in the order of its contract.


def to_products(raw: DataFrame) -> DataFrame:
    """Product rows without the HTML body and the nested variants."""
    return raw.select(
        "event_id", "id", "title", "vendor", "product_type", "handle", "status", "tags",
        ts_wallclock(F.col("created_at")).alias("created_at"),
        ts_wallclock(F.col("updated_at")).alias("updated_at"),
        ts_wallclock(F.col("published_at")).alias("published_at"),
    )


def to_inventory_levels(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id", "inventory_item_id", "location_id", "available",
        ts_wallclock(F.col("updated_at")).alias("updated_at"),
    )


def to_order_details(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    """Order line rows: money typed, `grams` dropped."""
    return raw.select(
        "event_id", "order_id", "id", "variant_id", "product_id", "title", "variant_title", "name",
        "sku", "vendor", "quantity", "fulfillable_quantity", "current_quantity",
        money(F.col("price"), on_error).alias("price"),
        money(F.col("total_discount"), on_error).alias("total_discount"),
        "fulfillment_service", "fulfillment_status", "requires_shipping", "taxable", "gift_card",
        "product_exists", "variant_inventory_management",
        ts_wallclock(F.col("created_at")).alias("created_at"),
        ts_wallclock(F.col("updated_at")).alias("updated_at"),
    )


def to_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id", "id", "email", "first_name", "last_name", "phone", "state", "verified_email", "tags",
        ts_wallclock(F.col("created_at")).alias("created_at"),
        ts_wallclock(F.col("updated_at")).alias("updated_at"),
    )


def explode_variants(raw: DataFrame, position: bool = False) -> DataFrame:
    """One row per array element as column `v`, the parent's columns kept.

    Products whose list is empty or missing give no rows. With `position`, the
    1-based place of the element is added as `list_position`.
    """
    parents = raw.drop("variants")
    if position:
        out = raw.select(*[F.col(c) for c in parents.columns], F.posexplode("variants").alias("_pos", "v"))
        return out.withColumn("list_position", F.col("_pos") + 1).drop("_pos")
    return raw.select(*[F.col(c) for c in parents.columns], F.explode("variants").alias("v"))


def to_product_variants(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    """Variant rows of the product stream; `product_id` is the parent's id.

    The explode sees only the columns used here: nested pruning keeps `body_html`
    and unused variant fields out of a Parquet scan.
    """
    v = F.col("v")
    rows = raw.select(
        F.col("event_id").alias("p_event_id"), F.col("id").alias("p_id"), F.explode("variants").alias("v")
    )
    return rows.select(
        event_key(v["event_id"], F.col("p_event_id"), v["id"]).alias("event_id"),
        F.col("p_id").alias("product_id"),
        v["id"].alias("variant_id"),
        v["title"].alias("title"),
        money(v["price"], on_error).alias("price"),
        v["sku"].alias("sku"),
        v["position"].alias("position"),
        v["inventory_policy"].alias("inventory_policy"),
        money(v["compare_at_price"], on_error).alias("compare_at_price"),
        *[
            v[c].alias(c)
            for c in (
                "fulfillment_service", "inventory_management", "option1", "option2", "option3", "taxable",
                "barcode", "weight", "weight_unit", "inventory_item_id", "inventory_quantity",
                "requires_shipping",
            )
        ],
        ts_wallclock(v["created_at"]).alias("created_at"),
        ts_wallclock(v["updated_at"]).alias("updated_at"),
    )


ENVELOPE = ("topic", "partition", "offset", "key")


def to_consumed_order_details(raw: DataFrame, consumed_at: str = "consumed_at") -> DataFrame:
    """Order lines with their message envelope, as the stand-alone consumer stores them.

    `id` becomes `line_item_id` and the payload's times get a prefix, so that they
    do not collide with the store's own columns. Times are instants, money stays text.
    """
    return raw.select(
        *ENVELOPE, F.col(consumed_at).alias("consumed_at"),
        "order_id", F.col("id").alias("line_item_id"), "variant_id", "product_id", "title",
        "variant_title", "name", "sku", "vendor", "quantity", "fulfillable_quantity", "current_quantity",
        "price", "total_discount", "fulfillment_service", "fulfillment_status", "grams",
        "requires_shipping", "taxable", "gift_card", "product_exists", "variant_inventory_management",
        ts_instant(F.col("created_at")).alias("shopify_created_at"),
        ts_instant(F.col("updated_at")).alias("shopify_updated_at"),
    )


# Topic -> lake tables it feeds, with the projection of each.
TOPIC_OUTPUTS = {
    "products": {"products": to_products, "product_variants": to_product_variants},
    "inventory": {"inventory_levels": to_inventory_levels},
    "order_details": {"order_details": to_order_details},
    "customers": {"customers": to_customers},
}
