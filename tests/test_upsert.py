import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartstream import schemas
from cartstream.operators import webhooks as wh
from cartstream.operators.upsert import UpsertSpec, finalize, fold, latest_by_key, merge, upsert

T0 = datetime(2024, 1, 1)
SPEC = UpsertSpec(("id",), {"a": "last", "b": "last_present", "c": "last_non_empty", "d": "first"}, order=("seq",))


def brute(rows):
    """Row by row in arrival order, as a store would apply them."""
    state = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        s = state.setdefault(r["id"], {"b": None, "c": None, "d": r["d"]})
        s["a"] = r["a"]
        if r["b"] is not None:
            s["b"] = r["b"]
        if r["c"]:
            s["c"] = r["c"]
    return {k: (v["a"], v["b"], v["c"], v["d"]) for k, v in state.items()}


def changes(n, seed):
    rnd = random.Random(seed)
    pick = lambda: rnd.choice([None, "", "x", "y", "z"])
    # One key holds a third of the rows.
    return [{"seq": i, "id": 0 if rnd.random() < 0.33 else rnd.randrange(1, 20), "a": pick(), "b": pick(), "c": pick(), "d": pick()}
            for i in range(n)]


def collected(df):
    return {r["id"]: (r["a"], r["b"], r["c"], r["d"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_is_the_row_by_row_state_however_batches_are_cut_and_ordered(spark, seed):
    rows = changes(300, seed)
    df = spark.createDataFrame(rows, "seq bigint, id bigint, a string, b string, c string, d string")
    want = brute(rows)
    assert collected(upsert(df, SPEC)) == want
    rnd = random.Random(seed)
    cut = F.col("seq") % rnd.randrange(2, 5)
    parts = [fold(df.filter(cut == k), SPEC) for k in range(5)]
    rnd.shuffle(parts)
    left = merge(parts[:2], SPEC)
    assert collected(finalize(merge([*parts[2:], left], SPEC), SPEC)) == want


def test_order_by_update_time_across_batches(spark):
    spec = SPEC.ordered_by("t", "seq")
    df = spark.createDataFrame(
        [(1, 1, 1, "a1", None, "a", "d1"), (2, 5, 1, "a5", None, "", "d5"), (3, 3, 1, "a3", "b3", "b", "d3")],
        "seq bigint, t bigint, id bigint, a string, b string, c string, d string")
    folds = [fold(df.filter("seq < 3"), spec), fold(df.filter("seq = 3"), spec)]
    # The late batch is older than the newest row, but newer than the e-mail the first batch kept.
    assert collected(finalize(merge(folds, spec), spec)) == {1: ("a5", "b3", "b", "d1")}


def landed(spark, bodies):
    rows = [(f"w{i}", topic, "", "shop", body if isinstance(body, str) else json.dumps(body), T0 + timedelta(minutes=i))
            for i, (topic, body) in enumerate(bodies)]
    return spark.createDataFrame(rows, schemas.LANDED_WEBHOOK)


def state(spark, table, bodies):
    out = upsert(wh.STATE_CHANGES[table](landed(spark, bodies)), wh.STATE_SPECS[table])
    return {r["id"]: r.asDict() for r in out.collect()}


def test_customer_contact_fields_survive_empty_updates(spark):
    got = state(spark, "customers", [
        ("customers/create", {"id": 1, "email": "a@x", "tags": ["v", "w"], "verified_email": True}),
        ("customers/update", {"id": 1, "tags": "t"}),
        ("customers/update", {"id": 1, "email": "", "first_name": "Bo"}),
    ])["1"]
    assert (got["email"], got["first_name"], got["state"], got["verified_email"], got["tags"]) == ("a@x", "Bo", "enabled", False, "")
    assert got["created_at"] == T0


def test_product_handle_is_emptied_and_title_kept(spark):
    got = state(spark, "products", [
        ("products/create", {"id": 1, "title": "T", "handle": "h", "status": "draft", "created_at": "2023-01-01T00:00:00Z"}),
        ("products/delete", {"id": 1, "handle": ""}),
    ])["1"]
    assert (got["title"], got["handle"], got["status"], got["created_at"]) == ("T", None, "active", datetime(2023, 1, 1))


def test_order_lines(spark):
    got = state(spark, "order_details", [
        ("orders/create", {"id": 9, "line_items": [
            {"id": 1, "product_id": 5, "title": "first", "quantity": 2, "price": 3.5},
            {"id": 2, "variant_id": 0, "title": None, "price": "4.1"}, {"id": 1, "title": "again", "price": "3"}]}),
        ("orders/updated", {"id": 9, "line_items": [{"id": 1, "title": "late", "price": 7}]}),
        ("orders/create", {"id": 10}), ("orders/create", {"id": 11, "line_items": []}),
    ])
    assert set(got) == {"1", "2"}
    assert (got["1"]["product_id"], got["1"]["title"], got["1"]["quantity"], got["1"]["price"]) == ("5", "first", 2, "7.00")
    assert (got["2"]["variant_id"], got["2"]["title"], got["2"]["quantity"], got["2"]["price"]) == (None, None, 1, "4.1")


def test_inventory_default_and_variants_parent(spark):
    inv = state(spark, "inventory_levels", [("inventory_levels/update", {"inventory_item_id": 1, "location_id": 2})])
    assert inv["1:2"]["available"] == 0
    var = state(spark, "product_variants", [("products/create", {"id": 3, "variants": [{"id": 7, "product_id": 99, "price": 1, "sku": ""}]})])
    assert (var["7"]["product_id"], var["7"]["price"], var["7"]["sku"]) == ("3", "1.00", None)


def test_dedup_counts_white_space_and_looks_at_the_audit(spark):
    df = landed(spark, [("a/create", "{}"), ("a/create", "{}"), ("a/create", "{ }"), ("b/create", "[]")])
    fresh = wh.dedup_payload(df, None)
    assert sorted(r["webhook_id"] for r in fresh.collect()) == ["w0", "w2", "w3"]
    audit = wh.to_audit(wh.dedup_in_batch(df.filter("body = '[]'")))
    assert sorted(r["webhook_id"] for r in wh.dedup_payload(df, audit).collect()) == ["w0", "w2"]


def test_digest_modes(spark):
    from cartstream.functions import hmac_sha256_base64, payload_hash

    df = landed(spark, [("a/create", "{}"), ("a/create", "[1]")])
    plain = df.withColumn("digest", F.when(F.col("body") == "{}", payload_hash(F.col("body"))))
    assert wh.verify_digest(plain, None).count() == 2
    assert [r["body"] for r in wh.verify_digest(plain, "s").collect()] == ["{}"]
    keyed = df.withColumn("digest", F.when(F.col("body") == "[1]", hmac_sha256_base64(F.col("body"), "s")))
    assert [r["body"] for r in wh.verify_digest(keyed, "s", "hmac_sha256_base64").collect()] == ["[1]"]


def test_latest_by_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None)], "k int, t int, v string")
    assert sorted(map(tuple, latest_by_key(df, ["k"], ["t"]).collect())) == [(1, 3, "c"), (2, 1, None)]


def test_unknown_policy():
    with pytest.raises(ValueError):
        UpsertSpec(("id",), {"a": "newest"})


@pytest.mark.parametrize("hot_rows", [0, 1, 2, 100])
def test_latest_by_key_sorts_rows_once_unless_their_key_is_hot(spark, hot_rows):
    rows = [(k % 50 if k < 60 else k, k, f"v{k}") for k in range(200)] + [(None, 1, "a"), (None, 2, "b"), (7, 57, "v57")]
    df = spark.createDataFrame(rows, "k bigint, t bigint, v string")
    out = latest_by_key(df, ["k"], ["t"], hot_rows)
    want = {}
    for r in rows:
        if r[0] not in want or r[1] > want[r[0]][1]:
            want[r[0]] = r
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want.values()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Without hot keys one sort, behind the shuffle; else those are combined before theirs as well.
    assert (plan.split("Final Plan")[-1].split("Initial Plan")[0].count("Sort [") == 1) == (hot_rows == 100)


def test_latest_by_key_of_rows_without_an_order(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 2, map('a', 2)) AS t(k, t, m)")
    assert [tuple(r) for r in latest_by_key(df, ["k"], ["t"]).collect()] == [(1, 2, {"a": 2})]
