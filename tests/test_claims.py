import json
import random
from datetime import datetime, timedelta

import pytest

from cartstream.operators.claims import grant
from cartstream.streaming import jobs
from cartstream.streaming.claims import ClaimIndex


def loop(events, held=()):
    """In order: (owner, value) -> granted; what each owner holds at the end."""
    holds = dict(held)
    out = []
    for owner, value in events:
        free = value is None or all(v != value for o, v in holds.items() if o != owner)
        if free:
            holds[owner] = value
        out.append(free)
    return out, {(v, o) for o, v in holds.items() if v is not None}


def random_claims(seed, n):
    rnd = random.Random(seed)
    owners, values = [f"o{i}" for i in range(7)], [None, "a", "b", "c", "d", "e"]
    return [(rnd.choice(owners), rnd.choice(values)) for _ in range(n)]


@pytest.mark.parametrize("seed, slice_rows", [(0, 1000), (1, 12)])
def test_grant_is_the_loop(spark, seed, slice_rows):
    events = random_claims(seed, 60)
    held = [("o1", "a"), ("x", "c")]
    df = spark.createDataFrame([(i, o, v) for i, (o, v) in enumerate(events)], "seq bigint, owner string, value string")
    got = grant(df, spark.createDataFrame(held, "owner string, value string"), ["seq"], slice_rows)
    assert [r["granted"] for r in got.orderBy("seq").collect()] == loop(events, held)[0]


def test_grant_of_one_value_and_of_nothing(spark):
    """A value that all ask for is settled over several slices; tables may be empty; NULL owners claim nothing."""
    df = spark.range(2000).selectExpr("id AS seq", "IF(id = 5, NULL, CAST(id AS string)) AS owner", "'v' AS value")
    got = grant(df.repartition(6), None, ["seq"], 700)
    assert [r["seq"] for r in got.filter("granted").orderBy("seq").collect()] == [0, 5]
    assert grant(df.limit(0), None, ["seq"]).count() == 0


def test_index_over_batches_with_replays(spark, tmp_path):
    index, start = ClaimIndex(spark, str(tmp_path)), datetime(2024, 1, 1)
    events = random_claims(9, 24)
    want, holds = loop(events)
    for batch in range(3):
        rows = [(o, v, start + timedelta(seconds=i), None if i % 2 else f"w{i}", f"{i:03d}") for i, (o, v) in enumerate(events)]
        part = spark.createDataFrame(
            rows[batch * 8:batch * 8 + 8], "owner string, value string, received_at timestamp, webhook_id string, payload_hash string")
        for _ in range(2):  # a batch that runs again decides as before
            judged = index.judge(part, batch)
            got = [r["granted"] for r in judged.orderBy("payload_hash").collect()]
            assert got == want[batch * 8:batch * 8 + 8]
            index.store(judged, batch)
    assert {(r["value"], r["owner"]) for r in index.read().collect()} == holds

    late = spark.createDataFrame(
        [("o1", "z", start - timedelta(days=1), "w", "x")],
        "owner string, value string, received_at timestamp, webhook_id string, payload_hash string")
    row = index.judge(late, 3).first()
    assert (row["granted"], row["late"]) == (True, True)


@pytest.mark.parametrize("policy", ["upsert", "tombstone"])
def test_pipeline_sets_taken_handles_and_addresses_aside(spark, tmp_path, policy):
    pipe = jobs.WebhookPipeline(spark, str(tmp_path), delete_policy=policy, unique_values=True)
    start = datetime(2024, 1, 1)

    def hooks(first, *items):
        rows = [(f"w{first + i}", topic, None, json.dumps(body), start + timedelta(seconds=first + i)) for i, (topic, body) in enumerate(items)]
        return spark.createDataFrame(rows, "webhook_id string, topic string, digest string, body string, received_at timestamp")

    one = hooks(
        0, ("products/create", {"id": 1, "title": "A", "handle": "h"}), ("products/create", {"id": 2, "title": "B", "handle": "h"}),
        ("customers/create", {"id": 7, "email": "x@y.z"}), ("customers/update", {"id": 8, "email": "x@y.z"}),
        ("customers/update", {"id": 7, "email": "", "first_name": "F"}),
    )
    two = hooks(
        10, ("products/update", {"id": 1, "title": "A", "handle": "g"}), ("products/create", {"id": 2, "title": "B", "handle": "h"}),
        ("products/create", {"id": 3, "title": "C", "handle": "h"}), ("customers/delete", {"id": 7}),
        ("customers/update", {"id": 9, "email": "x@y.z"}),
    )
    for batch_id, batch in ((0, one), (0, one), (1, two), (1, two)):
        pipe.process(batch, batch_id)
    assert {(r["id"], r["handle"]) for r in pipe.read("products").collect()} == {("1", "g"), ("2", "h")}
    emails = {(r["id"], r["email"]) for r in pipe.read("customers").collect()}
    taken = sorted((r["webhook_id"], r["verdict"]) for r in pipe.rejected.read().collect())
    assert taken[:2] == [("w1", "handle is taken"), ("w12", "handle is taken")]
    if policy == "tombstone":
        assert emails == {("9", "x@y.z")} and taken[2:] == [("w3", "email is taken")]
    else:
        assert emails == {("7", "x@y.z")} and taken[2:] == [("w14", "email is taken"), ("w3", "email is taken")]
