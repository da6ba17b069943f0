import base64
import hashlib
import hmac
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartstream import functions as fn


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()


def test_times_wallclock_and_instant(spark):
    text = F.lit("2024-01-15T10:30:00-05:00")
    got = one(spark, wall=fn.ts_wallclock(text), instant=fn.ts_instant(text).cast("timestamp_ntz"),
              bad=fn.ts_wallclock(F.lit("garbage")), none=fn.ts_instant(F.lit(None).cast("string")))
    assert got["wall"] == datetime(2024, 1, 15, 10, 30)
    assert got["instant"] == datetime(2024, 1, 15, 15, 30)
    assert got["bad"] is None and got["none"] is None
    with pytest.raises(Exception):
        one(spark, t=fn.ts_instant(F.lit("garbage")))


def test_money_rounds_half_up_and_fails_or_nulls(spark):
    rows = spark.createDataFrame([("19.995",), ("-19.995",), (None,)], "p string")
    assert [r[0] for r in rows.select(fn.money(F.col("p"))).collect()] == [Decimal("20.00"), Decimal("-20.00"), None]
    for bad in ("abc", "123456789.00"):
        assert one(spark, m=fn.money(F.lit(bad), "null"))["m"] is None
        with pytest.raises(Exception):
            one(spark, m=fn.money(F.lit(bad), "fail"))
    with pytest.raises(ValueError):
        fn.money(F.lit("1"), "ignore")


def test_handle_keeps_double_hyphens(spark):
    assert one(spark, h=fn.handle(F.lit("Red T-Shirt & Co")))["h"] == "red-t-shirt--co"


def test_topics(spark):
    rows = spark.createDataFrame([("orders/updated",), ("foo/create",), ("inventory_levels/update",), ("products/delete",)], "t string")
    t = F.col("t")
    got = [tuple(r) for r in rows.select(fn.topic_table(t), fn.topic_operation(t), fn.topic_type(t)).collect()]
    assert got == [
        ("order_details", "update", "order"), ("unknown", "create", "foo"),
        ("inventory_levels", "update", "inventory_level"), ("products", "delete", "product"),
    ]


def test_tags_and_price_by_json_type(spark):
    rows = spark.createDataFrame([('["a", null, "b"]', "5"), ('"[x], y"', '"7.5"'), ("null", "1.005"), ("3", "null")], "t string, p string")
    got = rows.select(fn.join_tags(F.parse_json("t")), fn.price_text(F.parse_json("p"))).collect()
    assert [tuple(r) for r in got] == [("a,,b", "5.00"), ("[x], y", "7.5"), ("", "1.01"), ("", None)]


def test_titles_keys_and_ids(spark):
    null = F.lit(None).cast("string")
    got = one(
        spark, both=fn.variant_title(F.lit("S"), F.lit("Wool")), one=fn.variant_title(F.lit("S"), null),
        none=fn.variant_title(null, null), key=fn.composite_key(F.lit(7), null), sku=fn.sku(F.lit(1), F.lit(2)),
        zero=fn.truthy_id(F.lit("0")), grams=fn.grams(F.lit(2.0)),
        tags=fn.split_tags(F.lit("a, b,c")), own=fn.event_key(null, F.lit("p"), F.lit(3)),
    )
    assert got == {"both": "S / Wool", "one": "S", "none": "Default Title", "key": "7:", "sku": "SKU-1-2",
                   "zero": None, "grams": 907, "tags": ["a", "b", "c"], "own": "p:3"}


@pytest.mark.parametrize("secret", ["k", "x" * 100])
def test_hmac_matches_the_standard_library(spark, secret):
    body = '{"é": 1}'
    want = base64.b64encode(hmac.new(secret.encode(), body.encode(), hashlib.sha256).digest()).decode()
    assert one(spark, h=fn.hmac_sha256_base64(F.lit(body), secret))["h"] == want


def test_default_time_and_event_ids(spark):
    now = F.lit("2024-05-05 00:00:00").cast("timestamp")
    got = one(spark, given=fn.ts_or_default(F.lit("2024-01-01T00:00:00Z"), now).cast("timestamp_ntz"),
              empty=fn.ts_or_default(F.lit(""), now).cast("timestamp_ntz"), no_time=fn.unix_floor(F.lit(None).cast("timestamp")))
    assert got == {"given": datetime(2024, 1, 1), "empty": datetime(2024, 5, 5), "no_time": 0}
    assert spark.range(50).select(fn.new_event_id().alias("e")).distinct().count() == 50
