"""Lookups and referential checks between event tables.

All joins are equi-joins against a side with one row per key. Nothing but the
few hot keys of `product_lines` is broadcast by hand: adaptive execution broadcasts a side whose measured size
allows it and otherwise splits the skewed partitions of the big side, be it a hot
key or the rows without one. Checks filter NULL keys out before they join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartstream.functions import line_name, variant_title
from cartstream.operators.ordered import HOT_ROWS, hot_groups, row_numbers
from cartstream.operators.upsert import latest_by_key


LOOKUP_COLUMNS = (
    "variant_id", "product_id", "price", "grams", "sku", "option1", "option2", "inventory_management",
)


def variant_lookup(variants: DataFrame, max_age: str | None = None, now=None) -> DataFrame:
    """Newest row per inventory item; with `max_age`, only items updated since `now` - age.

    Keeps the columns the enrichment uses, so that the rest is pruned from the scan.

    This is the bounded lookup state: bounded by age, so what is kept does not
    depend on chance.
    """
    used = ("inventory_item_id", "updated_at", *LOOKUP_COLUMNS)
    rows = variants.select(*[c for c in used if c in variants.columns])
    if max_age is not None:
        rows = rows.filter(F.col("updated_at") > F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {max_age}"))
    return latest_by_key(rows, ["inventory_item_id"], ["updated_at", "variant_id"])


def enrich_order_details(items: DataFrame, variants: DataFrame) -> DataFrame:
    """Order lines completed from the variant they refer to by inventory item.

    On a hit price, grams, SKU, ids, title and inventory management come from the
    variant; on a miss the line keeps its own values and has no ids.
    `variants` needs one row per `inventory_item_id` (see `variant_lookup`) with
    `LOOKUP_COLUMNS`.
    """
    v = variants.select(
        "inventory_item_id", F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_{c}") for c in LOOKUP_COLUMNS],
    )
    hit = F.col("_hit").isNotNull()
    title = F.when(hit, variant_title(F.col("_option1"), F.col("_option2"))).otherwise(
        variant_title(F.lit(None).cast("string"), F.lit(None).cast("string"))
    )
    joined = items.join(v, "inventory_item_id", "left")
    out = {
        "variant_id": F.col("_variant_id"),
        "product_id": F.col("_product_id"),
        "price": F.when(hit, F.col("_price")).otherwise(F.col("price")),
        "grams": F.when(hit, F.col("_grams")).otherwise(F.col("grams")),
        "sku": F.when(hit, F.col("_sku")).otherwise(F.col("sku")),
        "variant_title": title,
        "name": line_name(F.col("title"), title),
        "variant_inventory_management": F.coalesce(F.col("_inventory_management"), F.lit("shopify")),
    }
    rest = [F.col(c) for c in items.columns if c not in out]
    return joined.select(*rest, *[c.alias(n) for n, c in out.items()])


def enrich_inventory(inventory: DataFrame, variants: DataFrame, products: DataFrame) -> DataFrame:
    """Inventory levels with SKU, product id and product title (implied by the model, not run there).

    The dimensions are joined with each other first: both are far smaller than the
    level stream, which then crosses the network once.
    """
    dim = variants.select("inventory_item_id", "sku", "product_id").join(
        products.select(F.col("id").alias("product_id"), F.col("title").alias("product_title")),
        "product_id", "left",
    )
    return inventory.join(dim, "inventory_item_id", "left")


def distinct_keys(dim: DataFrame, dim_key: str, key: str) -> DataFrame:
    return dim.select(F.col(dim_key).alias(key)).filter(F.col(key).isNotNull()).distinct()


def keep_known(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows whose key exists in the dimension; an empty dimension keeps none."""
    known = distinct_keys(dim, dim_key or key, key)
    return df.filter(F.col(key).isNotNull()).join(known, key, "left_semi")


def orphans(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows whose non-NULL key does not exist in the dimension."""
    known = distinct_keys(dim, dim_key or key, key)
    return df.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def fk_check(
    df: DataFrame, parent: DataFrame, fk: str, parent_key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the foreign key, rows that break it); a NULL key passes."""
    checked = fk_flagged(df, parent, fk, parent_key)
    return checked.filter("_fk_ok").drop("_fk_ok"), checked.filter("not _fk_ok").drop("_fk_ok")


def fk_flagged(df: DataFrame, parent: DataFrame, fk: str, parent_key: str = "id", flag: str = "_fk_ok") -> DataFrame:
    """The rows with a flag: is the foreign key NULL or known? One scan of either side and one join."""
    known = distinct_keys(parent, parent_key, fk).withColumn("_known", F.lit(True))
    joined = df.join(known, fk, "left").withColumn(flag, F.col(fk).isNull() | F.col("_known").isNotNull())
    return joined.select(*df.columns, flag)


def cascade_delete(child: DataFrame, deletes: DataFrame, key: str, delete_key: str = "id") -> DataFrame:
    """Child rows left after their parents were deleted; rows without a parent stay."""
    gone = distinct_keys(deletes, delete_key, key)
    kept = child.filter(F.col(key).isNotNull()).join(gone, key, "left_anti")
    return kept.unionByName(child.filter(F.col(key).isNull()))


def product_360(products: DataFrame, variants: DataFrame, order_details: DataFrame) -> DataFrame:
    """Parent-child view: one row per product and variant, with the order totals of the variant.

    Flat on purpose. Order lines are summed before they meet their parent (partial
    sums leave each map task), so a best seller is one row and never a list.
    Products without variants keep one row with NULL variant columns.
    """
    sold = order_details.filter(F.col("variant_id").isNotNull()).groupBy("variant_id").agg(
        F.count("*").alias("n_lines"),
        F.sum("quantity").alias("units"),
        F.sum(F.col("price") * F.col("quantity")).cast("decimal(28,2)").alias("revenue"),
    )
    v = variants.select("product_id", "variant_id", "sku", "price").join(sold, "variant_id", "left")
    p = products.select(F.col("id").alias("product_id"), "title", "status")
    return p.join(v, "product_id", "left").select(
        "product_id", "title", "status", "variant_id", "sku", "price",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("units", F.lit(0)).alias("units"),
        F.coalesce("revenue", F.lit(0).cast("decimal(28,2)")).alias("revenue"),
    )


def product_lines(
    products: DataFrame, order_details: DataFrame, chunk_rows: int = 1000, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Parent-child view with the lines: one row per product and chunk of at most `chunk_rows` of its order lines, by id, then event_id.

    A product's lines are dealt to one task, which numbers and lists them; those of a best seller (more than `hot_rows` lines) are
    numbered in slices and are many chunks made by many tasks. No list outgrows the bound. Products
    without lines keep one row with chunk 0 and no lines. An event_id occurs once.
    """
    used = ["id", "event_id", "order_id", "variant_id", "quantity", "price"]
    lines = order_details.filter(F.col("product_id").isNotNull()).select("product_id", *used)
    goods = products.select(F.col("id").alias("product_id"), "title", "status")
    along = Window.partitionBy("product_id").orderBy("id", "event_id")
    number = lambda rows: rows.withColumn("_n", F.row_number().over(along))
    hot = hot_groups(lines, ["product_id"], hot_rows)
    if hot is None:
        return _chunked(goods, number(lines), used, chunk_rows)
    best = F.broadcast(hot)
    many = row_numbers(lines.join(best, "product_id", "left_semi"), ["product_id"], ["id", "event_id"], "_n")
    usual = _chunked(goods.join(best, "product_id", "left_anti"), number(lines.join(best, "product_id", "left_anti")), used, chunk_rows)
    return usual.unionByName(_chunked(goods.join(best, "product_id", "left_semi"), many, used, chunk_rows))


def _chunked(p: DataFrame, numbered: DataFrame, used: list[str], chunk_rows: int) -> DataFrame:
    """Products with their lines (product_id, _n, used…) in chunks."""
    chunks = numbered.groupBy("product_id", F.floor((F.col("_n") - 1) / chunk_rows).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct(*used))).alias("lines")
    )
    return p.join(chunks, "product_id", "left").select(
        "product_id", "title", "status", F.coalesce("chunk", F.lit(0).cast("bigint")).alias("chunk"),
        F.coalesce("lines", F.array().cast(chunks.schema["lines"].dataType)).alias("lines"),
    )
