"""Webhook requests: check, deduplicate, audit, and turn bodies into state changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartstream import schemas
from cartstream.functions import (
    composite_key, hmac_sha256_base64, is_blank, join_tags, non_empty, payload_hash, price_text, to_text,
    topic_operation, topic_table, topics_of, truthy_id, ts_or_default,
)
from cartstream.operators.upsert import UpsertSpec

ARRIVAL = ("received_at", "webhook_id")


# -- admission ---------------------------------------------------------------

def digest_ok(secret: str | None, mode: str = "sha256_hex") -> Column:
    """True when the `digest` header fits the body, or when no secret is configured.

    mode 'sha256_hex' compares the plain SHA-256 of the body (the secret only turns
    the check on); 'hmac_sha256_base64' is the keyed check the header is meant for.
    """
    if not secret:
        return F.lit(True)
    if mode == "sha256_hex":
        return F.coalesce(F.col("digest"), F.lit("")) == payload_hash(F.col("body"))
    if mode == "hmac_sha256_base64":
        return F.coalesce(F.col("digest"), F.lit("")) == hmac_sha256_base64(F.col("body"), secret)
    raise ValueError(f"unknown digest mode {mode!r}")


def verify_digest(df: DataFrame, secret: str | None, mode: str = "sha256_hex") -> DataFrame:
    """Only the requests whose digest fits."""
    return df.filter(digest_ok(secret, mode))


def json_ok(body: Column) -> Column:
    return F.try_parse_json(body).isNotNull()


def split_valid_json(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsable, not parsable) requests."""
    return df.filter(json_ok(F.col("body"))), df.filter(~json_ok(F.col("body")))


def admission(df: DataFrame, secret: str | None = None, mode: str = "sha256_hex") -> DataFrame:
    """Every request with its verdict: accepted, bad_digest or bad_json, in one pass."""
    verdict = (
        F.when(~digest_ok(secret, mode), "bad_digest")
        .when(~json_ok(F.col("body")), "bad_json")
        .otherwise("accepted")
    )
    return df.withColumn("verdict", verdict)


_CHECKED = (
    "title string, created_at string, updated_at string, variants array<struct<created_at: string, updated_at: string>>, "
    "line_items array<struct<created_at: string, updated_at: string>>"
)


def unusable(topic: Column, body: Column) -> Column:
    """Why a parsable body cannot be applied to the state, or NULL: a create without its title, a time that is none.

    An update may leave the title out, it keeps the stored one.
    """
    b = F.from_json(body, _CHECKED)
    no_title = lambda c: is_blank(F.coalesce(c, F.lit("")))
    no_time = lambda c: F.nullif(c, F.lit("")).isNotNull() & F.try_to_timestamp(c).isNull()
    inside = lambda items: F.coalesce(
        F.exists(items, lambda x: no_time(x["created_at"]) | no_time(x["updated_at"])), F.lit(False))
    return (
        F.when((topic == "products/create") & no_title(b["title"]), "title is missing")
        .when(no_time(b["created_at"]), "created_at is not a time").when(no_time(b["updated_at"]), "updated_at is not a time")
        .when(inside(b["variants"]) | inside(b["line_items"]), "a nested time is not a time")
    )


def screened(df: DataFrame, secret: str | None = None, mode: str = "sha256_hex") -> DataFrame:
    """As `admission`, with the reason as the verdict of bodies that cannot be applied."""
    reason = F.when(F.col("verdict") == "accepted", unusable(F.col("topic"), F.col("body")))
    return admission(df, secret, mode).withColumn("verdict", F.coalesce(reason, F.col("verdict")))


# -- audit and deduplication -------------------------------------------------

def dedup_in_batch(df: DataFrame, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """First request per payload hash.

    Grouping combines before the shuffle, so copies of one body (be they a third
    of all rows) collapse to one row per map task.
    """
    hashed = df.withColumn("payload_hash", payload_hash(F.col("body")))
    first = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    out = hashed.groupBy("payload_hash").agg(first)
    return out.select(*[F.col("_row")[c].alias(c) for c in df.columns], "payload_hash")


def dedup_payload(df: DataFrame, audit: DataFrame | None, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Requests whose body was never seen: not earlier in the batch, not in the audit.

    The history is first cut down to the hashes of this batch. The batch side of
    that join is small, so it is broadcast when the run-time size allows and the
    history is scanned (one column) without being shuffled.
    """
    fresh = dedup_in_batch(df, order)
    if audit is None:
        return fresh
    seen = audit.select("payload_hash").join(fresh.select("payload_hash"), "payload_hash", "left_semi")
    return fresh.join(seen, "payload_hash", "left_anti")


def to_audit(df: DataFrame) -> DataFrame:
    """Audit rows of accepted, deduplicated requests."""
    return df.select(
        F.coalesce(F.col("webhook_id"), F.lit("unknown")).alias("source_id"),
        F.coalesce(F.col("topic"), F.lit("unknown")).alias("topic"),
        topic_table(F.col("topic")).alias("table_name"),
        topic_operation(F.coalesce(F.col("topic"), F.lit(""))).alias("operation"),
        "payload_hash",
        F.col("received_at").alias("created_at"),
    )


# Columns that no two rows of a state table may share.
UNIQUE = {"products": "handle", "customers": "email"}


def unique_claims(df: DataFrame, table: str, delete_policy: str = "upsert") -> DataFrame:
    """What deduplicated requests of a table ask for of its unique column: owner, value, arrival, payload_hash.

    As in the state, an emptied handle lets go, while an empty e-mail address keeps the stored one and is left out. Under 'tombstone' a
    delete lets go.
    """
    column = UNIQUE[table]
    b = F.from_json("body", f"id string, {column} string")
    rows = df.filter(F.col("topic").isin(topics_of(table))).select(
        b["id"].alias("owner"), non_empty(b[column]).alias("value"), *ARRIVAL, "payload_hash",
        F.col("topic").endswith("/delete").alias("_delete"),
    )
    if delete_policy == "tombstone":
        rows = rows.withColumn("value", F.when(~F.col("_delete"), F.col("value")))
    if STATE_SPECS[table].columns[column] == "last_non_empty":
        empty = F.col("value").isNull()
        rows = rows.filter(~empty | F.col("_delete") if delete_policy == "tombstone" else ~empty)
    return rows.drop("_delete")


# -- bodies to changes -------------------------------------------------------

def parsed(df: DataFrame, table: str, body_schema: str, delete_policy: str = "upsert") -> DataFrame:
    """Requests of one table with the body parsed as `b`.

    delete_policy 'upsert' treats a delete like an update; 'tombstone' leaves the
    deletes out, see `deleted_keys`.
    """
    topics = topics_of(table)
    if delete_policy == "tombstone":
        topics = [t for t in topics if not t.endswith("/delete")]
    return df.filter(F.col("topic").isin(topics)).select(
        *ARRIVAL, F.from_json("body", body_schema).alias("b")
    )


def deleted_keys(df: DataFrame, table: str) -> DataFrame:
    """Keys named by delete requests, with the newest arrival of each."""
    topics = [t for t in topics_of(table) if t.endswith("/delete")]
    rows = df.filter(F.col("topic").isin(topics)).select(
        F.from_json("body", "id string")["id"].alias("id"), F.col("received_at").alias("deleted_at")
    )
    return rows.groupBy("id").agg(F.max("deleted_at").alias("deleted_at"))


def product_changes(df: DataFrame, delete_policy: str = "upsert") -> DataFrame:
    b, now = F.col("b"), F.col("received_at")
    return parsed(df, "products", schemas.BODY_PRODUCT, delete_policy).select(
        to_text(b["id"]).alias("id"), *ARRIVAL, F.lit(0).alias("item"),
        b["title"].alias("title"),
        non_empty(b["handle"]).alias("handle"),
        F.coalesce(non_empty(b["status"]), F.lit("active")).alias("status"),
        join_tags(b["tags"]).alias("tags"),
        ts_or_default(b["created_at"], now).alias("created_at"),
        ts_or_default(b["updated_at"], now).alias("updated_at"),
    )


def variant_changes(df: DataFrame, delete_policy: str = "upsert") -> DataFrame:
    """Variants embedded in product bodies; `product_id` is the parent's id."""
    v, now = F.col("v"), F.col("received_at")
    rows = parsed(df, "products", schemas.BODY_PRODUCT, delete_policy).select(
        *ARRIVAL, F.col("b.id").alias("p_id"), F.posexplode("b.variants").alias("item", "v")
    )
    return rows.select(
        to_text(v["id"]).alias("id"), *ARRIVAL, "item",
        to_text(F.col("p_id")).alias("product_id"),
        price_text(v["price"]).alias("price"),
        non_empty(v["sku"]).alias("sku"),
        ts_or_default(v["created_at"], now).alias("created_at"),
        ts_or_default(v["updated_at"], now).alias("updated_at"),
    )


def inventory_changes(df: DataFrame) -> DataFrame:
    b, now = F.col("b"), F.col("received_at")
    return parsed(df, "inventory_levels", schemas.BODY_INVENTORY).select(
        composite_key(b["inventory_item_id"], b["location_id"]).alias("id"), *ARRIVAL,
        F.lit(0).alias("item"),
        to_text(b["inventory_item_id"]).alias("inventory_item_id"),
        to_text(b["location_id"]).alias("location_id"),
        F.coalesce(b["available"], F.lit(0)).alias("available"),
        ts_or_default(b["updated_at"], now).alias("updated_at"),
    )


def line_item_changes(df: DataFrame, delete_policy: str = "upsert") -> DataFrame:
    """Line items of order bodies; `order_id` is the order's id."""
    i, now = F.col("i"), F.col("received_at")
    rows = parsed(df, "order_details", schemas.BODY_ORDER, delete_policy).select(
        *ARRIVAL, F.col("b.id").alias("o_id"), F.posexplode("b.line_items").alias("item", "i")
    )
    return rows.select(
        to_text(i["id"]).alias("id"), *ARRIVAL, "item",
        to_text(F.col("o_id")).alias("order_id"),
        truthy_id(i["product_id"]).alias("product_id"),
        truthy_id(i["variant_id"]).alias("variant_id"),
        i["title"].alias("title"),
        i["quantity"].alias("quantity"),
        price_text(i["price"]).alias("price"),
        ts_or_default(i["created_at"], now).alias("created_at"),
        ts_or_default(i["updated_at"], now).alias("updated_at"),
    )


def customer_changes(df: DataFrame, delete_policy: str = "upsert") -> DataFrame:
    b, now = F.col("b"), F.col("received_at")
    return parsed(df, "customers", schemas.BODY_CUSTOMER, delete_policy).select(
        to_text(b["id"]).alias("id"), *ARRIVAL, F.lit(0).alias("item"),
        b["email"].alias("email"),
        b["first_name"].alias("first_name"),
        b["last_name"].alias("last_name"),
        b["phone"].alias("phone"),
        F.coalesce(non_empty(b["state"]), F.lit("enabled")).alias("state"),
        F.coalesce(b["verified_email"], F.lit(False)).alias("verified_email"),
        join_tags(b["tags"]).alias("tags"),
        ts_or_default(b["created_at"], now).alias("created_at"),
        ts_or_default(b["updated_at"], now).alias("updated_at"),
    )


STATE_SPECS = {
    "products": UpsertSpec(
        ("id",),
        {
            "title": "last_present", "handle": "last", "status": "last", "tags": "last",
            "created_at": "first", "updated_at": "last",
        },
    ),
    "product_variants": UpsertSpec(
        ("id",),
        {
            "product_id": "first", "price": "last", "sku": "last", "created_at": "first",
            "updated_at": "last",
        },
    ),
    "inventory_levels": UpsertSpec(
        ("id",),
        {
            "inventory_item_id": "first", "location_id": "first", "available": "last",
            "updated_at": "last",
        },
    ),
    "order_details": UpsertSpec(
        ("id",),
        {
            "order_id": "last", "product_id": "last_non_empty", "variant_id": "last_non_empty",
            "title": "first", "quantity": "last_present", "price": "last", "created_at": "first",
            "updated_at": "last",
        },
        defaults={"quantity": 1},
    ),
    "customers": UpsertSpec(
        ("id",),
        {
            "email": "last_non_empty", "first_name": "last_non_empty", "last_name": "last_non_empty",
            "phone": "last_non_empty", "state": "last", "verified_email": "last", "tags": "last",
            "created_at": "first", "updated_at": "last",
        },
    ),
}

STATE_CHANGES = {
    "products": product_changes,
    "product_variants": variant_changes,
    "inventory_levels": inventory_changes,
    "order_details": line_item_changes,
    "customers": customer_changes,
}
