"""Row validation, table quality reports, uniqueness and schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartstream.functions import is_blank

# What a stored order line must have.
ORDER_DETAIL_REQUIRED = (
    "topic", "partition", "offset", "consumed_at", "order_id", "line_item_id", "title", "name",
    "quantity", "fulfillable_quantity", "current_quantity", "price", "total_discount",
    "fulfillment_service", "grams",
)
ORDER_DETAIL_BOOLEANS = ("requires_shipping", "taxable", "gift_card", "product_exists")


def rejection_reasons(required, booleans, schema: T.StructType | None = None) -> Column:
    """Array of reasons a row is refused; empty when it is fine. Blank text counts as missing; by `schema` only text is looked at."""
    def missing(c: str) -> Column:
        if schema is not None and not isinstance(schema[c].dataType, T.StringType):
            return F.col(c).isNull()
        return F.col(c).isNull() | is_blank(F.col(c).cast("string"))

    checks = [
        F.when(missing(c), F.lit(f"{c} is missing"))
        for c in required
    ] + [F.when(F.col(c).isNull(), F.lit(f"{c} is not true or false")) for c in booleans]
    return F.array_compact(F.array(*checks))


def with_reasons(df: DataFrame, required, booleans) -> DataFrame:
    return df.withColumn("reasons", rejection_reasons(required, booleans, df.schema))


def validate(df: DataFrame, required, booleans=()) -> tuple[DataFrame, DataFrame]:
    """(valid rows, refused rows with their reasons)."""
    checked = with_reasons(df, required, booleans)
    return checked.filter(F.size("reasons") == 0).drop("reasons"), checked.filter(F.size("reasons") > 0)


def quality_report(df: DataFrame, not_null=(), unique=()) -> DataFrame:
    """One row per rule: (rule, column, violations). Rules are a recommendation, not enforced.

    All NULL rules share one scan. A uniqueness rule counts the surplus rows of
    duplicated values; it aggregates by the value (partial counts first), so a
    value that repeats in a third of all rows costs one row per map task.
    """
    parts = []
    if not_null:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        pairs = F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in not_null])
        ).alias("p")
        parts.append(counts.select(pairs).select(F.lit("not_null").alias("rule"), "p.column", "p.violations"))
    for c in unique:
        surplus = (
            df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations"))
        )
        parts.append(surplus.select(F.lit("unique").alias("rule"), F.lit(c).alias("column"), "violations"))
    if not parts:
        raise ValueError("no rules given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that break a unique constraint, with their row counts; NULLs are exempt."""
    present = df.dropna(subset=columns)
    return present.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Differences between a frame's schema and its contract: (column, expected, actual).

    Works on metadata only; no row is read.
    """
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    names = list(want) + [n for n in have if n not in want]
    rows = [(n, want.get(n), have.get(n)) for n in names if want.get(n) != have.get(n)]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string")


def body_drift(df: DataFrame, expected: dict[str, str], body: str = "body") -> DataFrame:
    """Top-level fields of JSON bodies whose type is not the contract's: (field, expected, actual, n_rows).

    Types are BIGINT, DECIMAL, DOUBLE, BOOLEAN, STRING, ARRAY, OBJECT. Fields the contract
    does not name have no expected type; null values and unparsable bodies are exempt.
    One pass: fields are counted by type before anything is shuffled.
    """
    fields = df.select(F.try_parse_json(body).alias("_v")).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("_v").outer())
    )
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    counted = fields.groupBy(F.col("key").alias("field"), kind.alias("actual")).agg(F.count("*").alias("n_rows"))
    want = F.lit(None).cast("string")
    for name, wanted in expected.items():
        want = F.when(F.col("field") == name, F.lit(wanted)).otherwise(want)
    out = counted.filter(F.col("field").isNotNull() & (F.col("actual") != "VOID")).withColumn("expected", want)
    return out.filter(~F.col("expected").eqNullSafe(F.col("actual"))).select("field", "expected", "actual", "n_rows")


def invariants(products: DataFrame, inventory: DataFrame, locations: int = 3) -> DataFrame:
    """Violation counts of what well-formed events promise: (check, violations).

    `products` is the raw product frame with nested variants. Checks per row are
    counted in one scan of each frame; uniqueness checks aggregate by id.
    """
    v = F.col("variants")
    bad_time = lambda c: F.try_to_timestamp(F.col(c)).isNull()
    per_product = {
        "product_fields_present": F.exists(
            F.array("title", "handle", "status", "tags", "created_at"),
            lambda x: F.coalesce(x, F.lit("")) == "",
        ),
        "one_to_three_variants": ~F.coalesce(F.size(v), F.lit(0)).between(1, 3),
        "product_time_parses": bad_time("created_at"),
        "variant_sku_prefix": F.exists(v, lambda x: ~F.coalesce(x["sku"].startswith("SKU-"), F.lit(False))),
        "variant_position_positive": F.exists(v, lambda x: F.coalesce(x["position"], F.lit(0)) < 1),
        "variant_parent_id": F.exists(v, lambda x: F.coalesce(x["product_id"], F.lit(-1)) != F.col("id")),
    }
    per_level = {
        "available_present": F.coalesce(F.col("available"), F.lit(-1)) < 0,
        "location_in_range": ~F.col("location_id").between(1, locations),
        "level_time_parses": bad_time("updated_at"),
    }

    def counted(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
        one = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
        pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in checks])
        return one.select(F.inline(pairs))

    variants = products.select(F.explode("variants").alias("v"))

    def surplus(df: DataFrame, column: Column, name: str) -> DataFrame:
        return (
            df.groupBy(column.alias("k")).agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations"))
            .select(F.lit(name).alias("check"), "violations")
        )

    return (
        counted(products, per_product)
        .unionByName(counted(inventory, per_level))
        .unionByName(surplus(products, F.col("id"), "product_id_unique"))
        .unionByName(surplus(variants, F.col("v.id"), "variant_id_unique"))
        .unionByName(surplus(variants, F.col("v.inventory_item_id"), "inventory_item_id_unique"))
    )
