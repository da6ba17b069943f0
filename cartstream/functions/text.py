"""Text functions: slugs, titles, SKUs, tags, keys. Column in, Column out, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_VARIANT_TITLE = "Default Title"


def handle(title: Column) -> Column:
    """URL handle: lower case, spaces to hyphens, anything else but a-z 0-9 - dropped.

    Hyphens are not collapsed: 'Red T-Shirt & Co' gives 'red-t-shirt--co'.
    """
    dashed = F.replace(F.lower(title), F.lit(" "), F.lit("-"))
    return F.regexp_replace(dashed, "[^a-z0-9-]", "")


def to_text(value: Column) -> Column:
    """NULL becomes '', anything else its text."""
    return F.coalesce(value.cast("string"), F.lit(""))


def non_empty(value: Column) -> Column:
    """Empty text becomes NULL."""
    return F.nullif(value, F.lit(""))


# The characters Unicode counts as white space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def is_blank(value: Column) -> Column:
    """Text of white space only, or none. Trimming from the left ends at the first other character."""
    return F.ltrim(value, F.lit(WHITE_SPACE)) == ""


def truthy_id(value: Column) -> Column:
    """Id text, or NULL for the values a sender uses to say 'no id' ('' and 0)."""
    return F.when(~value.isin("", "0"), value)


def split_tags(tags: Column) -> Column:
    """Comma list (with or without a blank after the comma) to an array."""
    return F.split(tags, ",\\s*")


def join_tags(tags: Column) -> Column:
    """Variant holding a text or a list of texts to one ','-joined text; else ''."""
    kind = F.schema_of_variant(tags)
    as_text = F.try_variant_get(tags, "$", "string")
    as_list = F.try_variant_get(tags, "$", "array<string>")
    return (
        F.when(kind == "STRING", as_text)
        .when(kind.startswith("ARRAY"), F.coalesce(F.array_join(as_list, ",", ""), F.lit("")))
        .otherwise(F.lit(""))
    )


def composite_key(*parts: Column) -> Column:
    """'a:b' key; a NULL part counts as ''."""
    return F.concat_ws(":", *[to_text(p) for p in parts])


def variant_title(option1: Column, option2: Column) -> Column:
    """'opt1', 'opt1 / opt2', or the default title; a third option is not shown."""
    both = F.concat_ws(" / ", option1, F.when(option1.isNotNull(), option2))
    return F.coalesce(non_empty(both), F.lit(DEFAULT_VARIANT_TITLE))


def line_name(title: Column, variant: Column) -> Column:
    return F.concat_ws(" - ", title, variant)


def sku(product_id: Column, variant_id: Column) -> Column:
    return F.concat(F.lit("SKU-"), product_id.cast("string"), F.lit("-"), variant_id.cast("string"))


def event_key(own: Column, parent: Column, child_id: Column) -> Column:
    """Event id of an exploded row: its own, or derived from its parent's."""
    return F.coalesce(own, F.concat(parent, F.lit(":"), child_id.cast("string")))


def new_event_id() -> Column:
    """Random UUID. Not repeatable: assign it once, when landing, never in a re-run step."""
    return F.uuid()
