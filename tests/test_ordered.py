"""Order-dependent operators against row-by-row loops."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartstream.operators import burst, climbing, handles, metrics
from cartstream.operators.ordered import row_numbers, running_sum

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_running_sum_of_hot_and_null_groups(spark, slices):
    rnd = random.Random(slices)
    rows = [(None if i % 11 == 0 else "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(30)}", i, rnd.randrange(10)) for i in range(500)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o bigint, v bigint")
    got = {r["o"]: r["s"] for r in running_sum(df, ["k"], ["o"], "v", "s", slices).collect()}
    want, total = {}, {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        total[k] = total.get(k, 0) + v
        want[o] = total[k]
    assert got == want
    assert row_numbers(df, ["k"], ["o"], slices=slices).filter("rn = 1").count() == df.select("k").distinct().count()


def loop_climb(rows):
    counts, out = {}, {}
    for k, o, limit in sorted(rows, key=lambda r: r[1]):
        out[o] = limit is not None and counts.setdefault(k, 0) <= limit
        counts[k] = counts.get(k, 0) + out[o]
    return out


@pytest.mark.parametrize("slices,seed", [(1, 1), (3, 2), (9, 3), (13, 4)])
def test_climb_is_the_loop(spark, slices, seed):
    rnd = random.Random(seed)
    key = lambda: rnd.choice(["hot", "hot", None, f"k{rnd.randrange(40)}"])
    limit = lambda: rnd.choice([None, -2, rnd.randrange(6), rnd.randrange(60), rnd.randrange(900), 10**18 - 1])
    rows = [(key(), i, limit()) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, o bigint, l bigint").repartition(4)
    got = {r["o"]: r["up"] for r in climbing.climb(df, ["k"], ["o"], "l", "up", slices).collect()}
    assert got == loop_climb(rows)
    assert climbing.climb(df.filter("false"), ["k"], ["o"], "l", "up", slices).count() == 0


def test_parts_go_on_over_batches():
    import numpy as np
    import pandas as pd

    rnd = np.random.default_rng(3)
    n = np.concatenate([np.arange(1, 41), [1], np.arange(1, 7), np.arange(1, 100)])
    pdf = pd.DataFrame({"o": range(len(n)), "_limit": rnd.integers(-1, 30, len(n)), "_n": n, "_entry": np.where(n[0] == 1, 2, 0)})
    want, count = [], 0
    for limit, place in zip(pdf["_limit"], n):
        count = 2 if place == 1 else count
        want.append(count <= limit)
        count += want[-1]
    for size in (1, 7, 40, 500):
        parts = [pdf.iloc[a:a + size] for a in range(0, len(pdf), size)]
        assert pd.concat(climbing._raise(iter(parts)))["_raised"].tolist() == want


def loop_handles(bases):
    used, out = set(), []
    for b in bases:
        name, i = b, 0
        while name in used:
            i += 1
            name = f"{b}-{i}"
        used.add(name)
        out.append(name)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_unique_handle_is_the_loop(spark, seed):
    rnd = random.Random(seed)
    names = ["a", "a", "a", "a-1", "a-2", "a-3", "a-1-1", "a-1-2", "a-12", "b", "b-1", "a-0", "a-01", "-1", "", "b-1-1-1"]
    bases = [rnd.choice(names) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(bases)), "seq bigint, base string").repartition(5)
    got = [r["handle"] for r in handles.unique_handle(df, slices=4).orderBy("seq").collect()]
    assert got == loop_handles(bases)
    assert len(set(got)) == len(got)


def test_unique_handle_of_long_chains_and_a_hot_root(spark):
    rnd = random.Random(9)
    chain = ["a" + "-1" * d for d in range(9)] + ["a" + "-1" * d + "-2" for d in range(6)]
    bases = [rnd.choice(chain) for _ in range(200)]
    hot = [f"b-{i}" for i in rnd.sample(range(1, 4000), 1500)] + ["b"] * 900 + ["b-7"] * 30
    rnd.shuffle(hot)
    bases += hot
    df = spark.createDataFrame(list(enumerate(bases)), "seq bigint, base string").repartition(5)
    got = [r["handle"] for r in handles.unique_handle(df, slices=8).orderBy("seq").collect()]
    assert got == loop_handles(bases)


def test_unique_handle_plain(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "a"), (4, None)], "seq bigint, base string")
    assert [r["handle"] for r in handles.unique_handle(df).orderBy("seq").collect()] == ["a", "a-1", "a-2", None]


def error_times(seed, n=400):
    rnd = random.Random(seed)
    t, out = 0.0, []
    for _ in range(n):
        t += rnd.choice([0, 0.25, 0.5, 1, 1, 2, 5, 30])
        out.append((T0 + timedelta(seconds=t), rnd.random() < 0.7))
    return out


@pytest.mark.parametrize("block", [20, 50, 600])
def test_error_burst_is_the_sliding_window(spark, block):
    times = [t for t, e in error_times(5) if e]
    df = spark.createDataFrame([("k", t) for t in times], "k string, ts timestamp_ntz")
    got = {r["ts"]: (r["n_window"], r["burst"]) for r in burst.error_burst(df, ["k"], block=block).collect()}
    for t in set(times):
        n = sum(1 for u in times if t - timedelta(seconds=10) <= u <= t)
        assert got[t] == (n, n >= 5)


def test_every_error_of_an_instant_has_a_row(spark):
    """Copies of an error, more than are listed at once, among others: as a window over the rows gives them."""
    many = 2 * burst.LISTED + 7
    rows = [("k", T0)] * many + [("k", T0 + timedelta(seconds=10))] * 2 + [("k", T0 + timedelta(seconds=11)), (None, T0), (None, T0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = Counter(tuple(r) for r in burst.error_burst(df, ["k"]).collect())
    assert got == {
        ("k", T0, many, True): many, ("k", T0 + timedelta(seconds=10), many + 2, True): 2, ("k", T0 + timedelta(seconds=11), 3, False): 1,
        (None, T0, 2, False): 2}


def test_burst_clears_after_silence(spark):
    df = spark.createDataFrame([("k", T0 + timedelta(seconds=s)) for s in (0, 1, 2, 3, 4, 15)], "k string, ts timestamp_ntz")
    got = {r["ts"]: r["burst"] for r in burst.error_burst(df, ["k"]).collect()}
    assert got[T0 + timedelta(seconds=4)] is True and got[T0 + timedelta(seconds=15)] is False


def loop_pauses(ticks, window=10, threshold=5, cooldown=5):
    """The state machine, tick by tick."""
    instants = {}
    for t, e in ticks:
        instants[t] = instants.get(t, 0) + e
    paused, out = None, []
    for t in sorted(instants):
        if paused is not None:
            if t >= paused + timedelta(seconds=cooldown):
                out[-1] = (paused, t)
                paused = None
            continue
        if sum(n for u, n in instants.items() if t - timedelta(seconds=window) <= u <= t) >= threshold:
            paused = t
            out.append((t, None))
    return out


@pytest.mark.parametrize("seed,block", [(1, 15), (2, 30), (3, 60), (4, 3600), (5, 7)])
def test_pauses_are_the_state_machine(spark, seed, block):
    by_key = {k: error_times(seed * 10 + i, 300) for i, k in enumerate(["k0", "k1", None])}
    rows = [(k, t, e) for k, ticks in by_key.items() for t, e in ticks]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, err boolean")
    got = burst.pause_intervals(df, ["k"], "err", block=block).collect()
    for k, ticks in by_key.items():
        mine = sorted((r["paused_at"], r["resumed_tick"]) for r in got if r["k"] == k)
        assert mine == sorted(loop_pauses(ticks), key=lambda p: p[0])
    assert all(r["resumes_at"] - r["paused_at"] == timedelta(seconds=5) for r in got)


def test_a_dense_second_is_many_slices(spark):
    rnd = random.Random(1)
    us = sorted(rnd.sample(range(1_000_000), 4000))
    rows = [("hot", T0 + timedelta(microseconds=u), True) for u in us] + [("hot", T0 + timedelta(seconds=s), True) for s in (20, 25)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, err boolean")
    got = sorted(tuple(r) for r in burst.error_burst(df, ["k"], block=500).select("ts", "n_window").collect())
    assert [n for _, n in got] == [*range(1, 4001), 1, 2]
    instants = df.select("k", burst.micros(F.col("ts")).alias("_us"), F.lit(1).cast("bigint").alias("n"))
    sizes = [r["count"] for r in burst._around(instants, ["k"], "n", 10_000_000, None, 8).groupBy("_slice").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 1500  # questions lie in the other slices
    assert burst.error_burst(df.withColumn("ts", F.lit(None).cast("timestamp_ntz")), ["k"]).count() == 0


@pytest.mark.parametrize("seed", [11, 12])
def test_one_key_over_many_slices(spark, monkeypatch, seed):
    monkeypatch.setattr(burst, "FAN", 3)  # several rounds up and down
    ticks = error_times(seed, 500)
    df = spark.createDataFrame([("k", t, e) for t, e in ticks], "k string, ts timestamp_ntz, err boolean")
    got = burst.pause_intervals(df, ["k"], "err", block=40).collect()
    assert sorted((r["paused_at"], r["resumed_tick"]) for r in got) == sorted(loop_pauses(ticks), key=lambda p: p[0])


def test_step_functions_compose_in_any_grouping():
    import numpy as np

    rnd = random.Random(5)
    runs, t = [], 0
    for _ in range(6):
        at = sorted(rnd.sample(range(t, t + 50), 8))
        runs.append(burst.Steps(np.array(at), np.array(sorted(a + rnd.randint(3, 30) for a in at)), at[0] + 60))
        t += 50
    a, b, c, d, e, f = runs
    left, right = a.then(b).then(c).then(d).then(e).then(f), a.then(b.then(c)).then(d.then(e.then(f)))
    for x in [-burst.NEVER, *range(-5, a.reach)]:
        one = np.array([x])
        want = one
        for run in runs:
            want = run(want)
        assert left(one) == right(one) == want


@pytest.mark.parametrize("seed,cuts", [(1, 3), (2, 5)])
def test_pauses_followed_batch_by_batch(spark, tmp_path, seed, cuts):
    from cartstream.streaming.pauses import PauseTracker

    by_key = {k: error_times(seed * 10 + i, 200) for i, k in enumerate(["k0", None])}
    rows = sorted(((k, t, e) for k, ticks in by_key.items() for t, e in ticks), key=lambda r: r[1])
    instants = sorted({t for _, t, _ in rows})
    bounds = [instants[len(instants) * i // cuts] for i in range(1, cuts)]
    tracker = PauseTracker(spark, str(tmp_path), ["k"], "err", block=60)
    for b in range(cuts):
        part = [r for r in rows if sum(r[1] >= c for c in bounds) == b]
        df = spark.createDataFrame(part, "k string, ts timestamp_ntz, err boolean")
        tracker.process(df, b)
        if b == 1:
            tracker.process(df, b)  # run again after a crash
    got = tracker.read().collect()
    for k, ticks in by_key.items():
        mine = sorted((r["paused_at"], r["resumed_tick"]) for r in got if r["k"] == k)
        assert mine == sorted(loop_pauses(ticks), key=lambda p: p[0])


# -- metrics -----------------------------------------------------------------

def sample_frame(spark, values, start=T0, step=15):
    rows = [("s", start + timedelta(seconds=i * step), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "s string, ts timestamp_ntz, value double")


def test_increase_counts_from_zero_after_a_reset(spark):
    got = metrics.counter_increase(sample_frame(spark, [0, 5, 2, 9]), ["s"], 60, 60).collect()
    assert [(r["increase"], r["n_samples"], r["rate"]) for r in got] == [(14.0, 4, 14.0 / 45)]


def test_increase_across_panes(spark):
    got = metrics.counter_increase(sample_frame(spark, range(40), step=15), ["s"], 300, 60).collect()
    full = {r["window_end"]: r["increase"] for r in got}
    assert full[T0 + timedelta(seconds=300)] == 19.0  # 20 samples, 19 steps, over five panes
    assert full[T0 + timedelta(seconds=60)] == 3.0


def loop_increase(samples, window, step):
    """(end, increase, n, seconds between the first and last sample) per window with samples."""
    found = {}
    for us, v in sorted(samples):
        first = (us // (step * 10**6) + 1) * step
        for end in range(first, us // 10**6 + window + 1, step):
            if (end - window) * 10**6 <= us < end * 10**6:
                found.setdefault(end, []).append((us, v))
    gain = lambda rows: sum(b - a if b >= a else b for (_, a), (_, b) in zip(rows, rows[1:]))
    return {e: (gain(r) if len(r) > 1 else None, len(r), (r[-1][0] - r[0][0]) / 10**6) for e, r in found.items()}


@pytest.mark.parametrize("window,step", [(7, 60), (60, 7), (13, 5), (10, 4), (4, 10), (1, 1), (30, 10), (97, 3)])
def test_increase_is_the_loop(spark, window, step):
    rnd = random.Random(window * 100 + step)
    series, rows = {"a": [], "b": [], None: []}, []
    for k, kept in series.items():
        us = -200 * 10**6  # from before the epoch on
        for _ in range(150):
            us += rnd.choice([1, 1000, 10**6, 2 * 10**6, 10**6 * rnd.randrange(1, 9), 120 * 10**6])
            v = None if rnd.random() < 0.1 else float(rnd.randrange(50))
            rows.append((k, datetime(1970, 1, 1) + timedelta(microseconds=us), v))
            if v is not None:
                kept.append((us, v))
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, value double").repartition(3)
    got = {k: {} for k in series}
    for r in metrics.counter_increase(df, ["s"], window, step).collect():
        end = int((r["window_end"] - datetime(1970, 1, 1)).total_seconds())
        assert end not in got[r["s"]]
        got[r["s"]][end] = (r["increase"], r["n_samples"], r["rate"])
    for k, samples in series.items():
        want = loop_increase(samples, window, step)
        assert {e: g[:2] for e, g in got[k].items()} == {e: w[:2] for e, w in want.items()}
        assert all(got[k][e][2] == pytest.approx(inc / sec) for e, (inc, _, sec) in want.items() if inc is not None)


def test_increase_orders_no_whole_series(spark):
    df = sample_frame(spark, range(400), step=1)
    out = metrics.counter_increase(df, ["s"], 7, 60)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" +-:").startswith("Window")]
    assert windows and all("_block" in w or "_pane" in w for w in windows)
    assert all(len(w.rsplit("], [", 2)[-2].split(",")) == 2 for w in windows)  # series and block, or series and pane
    assert {r["n_samples"] for r in out.collect()} == {7}


@pytest.mark.parametrize("ticks,fired", [(5, False), (6, True)])
def test_alert_needs_the_whole_hold_time(spark, ticks, fired):
    rows = [("lag", T0 + timedelta(minutes=i), 1001.0) for i in range(ticks)] + [("lag", T0 + timedelta(minutes=10), 1000.0)]
    vector = spark.createDataFrame(rows, "rule string, tick timestamp_ntz, value double")
    (got,) = metrics.alert_intervals(vector, ["rule"], *metrics.ALERT_RULES["consumer_lag_high"], metrics.EVALUATION_STEP).collect()
    assert got["n_ticks"] == ticks
    assert got["fired_at"] == (T0 + timedelta(minutes=5) if fired else None)


def test_instant_vector_looks_back_only_so_far(spark):
    df = spark.createDataFrame([("s", T0, 1.0), ("s", T0 + timedelta(seconds=70), 2.0)], "s string, ts timestamp_ntz, value double")
    got = {(r["tick"] - T0).seconds: r["value"] for r in metrics.instant_vector(df, ["s"], 60, 180).collect()}
    assert got == {0: 1.0, 60: 1.0, 120: 2.0, 180: 2.0, 240: 2.0}
    assert metrics.instant_vector(df, ["s"], 60, 180, start="2024-01-01 00:02:00", end="2024-01-01 00:03:00").count() == 2
    with pytest.raises(ValueError):
        metrics.instant_vector(df, ["s"], 60, 100)


def test_select_series_is_anchored(spark):
    df = spark.createDataFrame([(T0, "m", {"topic": t}, 1.0) for t in ("shopify.a", "x.shopify.a", "shopifyXa")],
                               "ts timestamp_ntz, metric string, labels map<string,string>, value double")
    assert [r["labels"]["topic"] for r in metrics.select_series(df, {"topic": "shopify[.].*"}).collect()] == ["shopify.a"]
    assert metrics.select_series(df, {}).count() == 3


def test_lag_is_never_negative(spark):
    ends = spark.createDataFrame([("t", 0, 10), ("t", 1, 5)], "topic string, partition int, end_offset bigint")
    done = spark.createDataFrame([("g", "t", 0, 4), ("g", "t", 1, 7)], "group_id string, topic string, partition int, committed bigint")
    lag = metrics.consumer_lag(ends, done)
    assert {r["partition"]: r["lag"] for r in lag.collect()} == {0: 6, 1: 0}
    assert metrics.max_lag(lag).first()["lag"] == 6


def test_threshold_steps(spark):
    df = spark.createDataFrame([(0.0,), (499.0,), (500.0,), (999.0,), (1000.0,), (None,)], "v double")
    got = [r[0] for r in df.select(metrics.threshold_state(F.col("v"), metrics.LAG_STEPS)).collect()]
    assert got == ["green", "green", "orange", "orange", "red", None]
