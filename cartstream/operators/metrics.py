"""Metric samples: instant vectors, rates, lag, alert intervals.

A series is a set of label columns. Times are whole microseconds since the epoch
inside the operators and zone-less timestamps outside.

Rates and increases use the samples inside a window only. They are not
extrapolated to the window's borders, which is where they differ from a
monitoring server's figures; a drop in a counter is a restart from 0.
"""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartstream.functions import topic_type

MICROS = 1_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def cell(us: Column, width: int) -> Column:
    """Number of the half-open cell [k * width, (k + 1) * width) a whole number lies in; exact."""
    return F.call_function("div", us - F.pmod(us, F.lit(width)), F.lit(width))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def with_labels(samples: DataFrame, names: list[str]) -> DataFrame:
    """(ts, metric, value) with the named labels as columns; a series is its metric and its labels."""
    labels = [F.col("labels")[n].alias(n) for n in names]
    return samples.select("ts", "metric", "value", *labels)


def select_series(
    samples: DataFrame, matchers: dict[str, str], equal: dict[str, str] | None = None, metric: str | None = None
) -> DataFrame:
    """Samples of a metric whose labels match: `matchers` are regexes over the whole value, `equal` exact values."""
    if metric is not None:
        samples = samples.filter(F.col("metric") == metric)
    tests = [F.coalesce(F.col("labels")[n], F.lit("")).rlike(f"^(?:{p})$") for n, p in matchers.items()]
    tests += [F.coalesce(F.col("labels")[n], F.lit("")) == v for n, v in (equal or {}).items()]
    return samples.filter(reduce(lambda a, b: a & b, tests)) if tests else samples


# -- instant vectors ---------------------------------------------------------

def instant_vector(
    samples: DataFrame, series: list[str], step: int, lookback: int, ts: str = "ts", value: str = "value",
    start=None, end=None,
) -> DataFrame:
    """(series…, tick, value): at each tick the newest sample not after it and younger than `lookback`.

    Ticks are the multiples of `step` seconds. A tick appears when it has a sample.
    Two aggregations, no ordered window and no range join: samples first collapse
    to the newest of their (tick - step, tick] cell, and only these go on to the
    lookback/step ticks they can serve.
    """
    if lookback % step:
        raise ValueError("lookback must be a multiple of step")
    us = step * MICROS
    newest = F.max_by(F.struct("_us", value), "_us")
    cells = (
        samples.withColumn("_us", micros(F.col(ts)))
        .withColumn("_cell", -cell(-F.col("_us"), us))
        .groupBy(*series, "_cell").agg(newest.alias("_s"))
    )
    served = cells.select(
        *series, "_s", F.explode(F.sequence("_cell", F.col("_cell") + lookback // step)).alias("_tick")
    ).filter(F.col("_tick") * us - F.col("_s._us") < lookback * MICROS)
    out = served.groupBy(*series, "_tick").agg(F.max_by(f"_s.{value}", "_s._us").alias(value))
    out = out.select(*series, from_micros(F.col("_tick") * us).alias("tick"), value)
    if start is not None:
        out = out.filter(F.col("tick") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out.filter(F.col("tick") <= F.lit(end).cast("timestamp_ntz"))
    return out


def latest_values(samples: DataFrame, series: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Newest value per series: what a stat panel shows."""
    return samples.filter(F.col(value).isNotNull()).groupBy(*series).agg(F.max_by(value, ts).alias(value))


def sum_gauge(vector: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Sum of gauges by label, all other labels dropped. `by` may hold the tick."""
    return vector.groupBy(*by).agg(F.sum(value).alias(value))


def max_all(vector: DataFrame, by: list[str] | None = None, value: str = "value") -> DataFrame:
    return vector.groupBy(*(by or [])).agg(F.max(value).alias(value))


def sum_all(vector: DataFrame, value: str = "value") -> DataFrame:
    return vector.agg(F.sum(value).alias(value))


# -- counters ----------------------------------------------------------------

def _gain(before: Column, after: Column) -> Column:
    """Growth of a counter between two samples; after a drop it grew from 0."""
    return F.when(after >= before, after - before).otherwise(after)


def _ends(after: Column, upto: Column, per_step: int) -> tuple[Column, Column]:
    """First and last multiple of `per_step` in (after, upto]; the first is the larger one if there is none."""
    return (cell(after, per_step) + 1) * per_step, cell(upto, per_step) * per_step


def _panes(
    samples: DataFrame, series: list[str], pane_us: int, per_window: int, per_step: int, ts: str, value: str
) -> DataFrame:
    """Per series and pane: first and last sample, sample count, growth inside the pane.

    Panes that lie between the windows are left out before anything is shuffled. The ordered window is limited to one series' samples of one pane, so a series that holds a
    third of all rows is spread over as many groups as it has panes.
    """
    w = Window.partitionBy(*series, "_pane").orderBy("_us")
    first_end, last_end = _ends(F.col("_pane"), F.col("_pane") + per_window, per_step)
    rows = (
        samples.filter(F.col(value).isNotNull())
        .withColumn("_us", micros(F.col(ts)))
        .withColumn("_pane", cell(F.col("_us"), pane_us))
        .filter(first_end <= last_end)
        .select(*series, "_us", "_pane", F.col(value).alias("_v"))
        .withColumn("_gain", _gain(F.lag("_v").over(w), F.col("_v")))
        .withColumn("_first", F.lag("_us").over(w).isNull())
    )
    return rows.groupBy(*series, "_pane").agg(
        F.min("_us").alias("_t0"), F.max("_us").alias("_t1"),
        F.min_by("_v", "_us").alias("_v0"), F.max_by("_v", "_us").alias("_v1"),
        F.coalesce(F.sum(F.when(~F.col("_first"), F.col("_gain"))), F.lit(0.0)).alias("_inc"),
        F.count("*").alias("_n"),
    )


def counter_increase(
    samples: DataFrame, series: list[str], window: int, step: int, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """(series…, window_end, increase, rate, n_samples) for windows [end - window, end), seconds.

    Samples are summed once into panes of width gcd(window, step), and panes into blocks as
    long as a window. A window that ends inside a block is what the block holds up to
    there, and what the block before holds from the window's start on: two look-ups,
    whatever the number of panes. Running sums stay inside a block, so one series is
    spread over as many groups as it has blocks. `rate` divides by the
    time between the window's first and last sample; both are NULL for one sample.
    """
    pane = gcd(window, step)
    us = pane * MICROS
    per_window, per_step = window // pane, step // pane
    along = Window.partitionBy(*series, "_block").orderBy("_pane")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    onward = along.rowsBetween(0, Window.unboundedFollowing)
    none = F.lit(0.0)
    begin = F.col("_block") * per_window
    panes = (
        _panes(samples, series, us, per_window, per_step, ts, value)
        .withColumn("_block", cell(F.col("_pane"), per_window))
        .withColumn("_was", F.lag("_v1").over(along))
        .withColumn("_before", F.when(F.col("_was").isNotNull(), _gain(F.col("_was"), F.col("_v0"))).otherwise(none))
        .withColumn("_after", F.coalesce(_gain(F.col("_v1"), F.lead("_v0").over(along)), none))
    )
    # A pane is the last one before the ends up to the next pane, and the first one from the starts after the pane before.
    closing = _ends(F.col("_pane"), F.coalesce(F.lead("_pane").over(along), begin + per_window), per_step)
    opening = _ends(F.coalesce(F.lag("_pane").over(along), begin) + per_window, F.col("_pane") + per_window, per_step)

    def side(late: bool, ends, inc, t0, t1, n, v) -> Column:
        values = {"late": F.lit(late), "a": ends[0], "b": ends[1], "inc": inc, "t0": t0, "t1": t1, "n": n, "v": v}
        return F.struct(*[c.alias(name) for name, c in values.items()])

    head = side(True, closing, F.sum(F.col("_inc") + F.col("_before")).over(upto), F.first("_t0").over(upto), F.col("_t1"),
                F.sum("_n").over(upto), F.first("_v0").over(upto))
    tail = side(False, opening, F.sum(F.col("_inc") + F.col("_after")).over(onward), F.col("_t0"), F.last("_t1").over(onward),
                F.sum("_n").over(onward), F.last("_v1").over(onward))
    found = (
        panes.select(*series, F.array(head, tail).alias("_sides"))
        .select(*series, F.explode("_sides").alias("_s")).filter("_s.a <= _s.b")
        .withColumn("_end", F.explode(F.sequence("_s.a", "_s.b", F.lit(per_step).cast("bigint"))))
    )
    # At most two rows a window; between them the counter goes from the early one's last value to the late one's first.
    late = F.col("_s.late")
    across = _gain(F.max(F.when(~late, F.col("_s.v"))), F.max(F.when(late, F.col("_s.v"))))
    summed = found.groupBy(*series, "_end").agg(
        (F.sum("_s.inc") + F.when(F.count("*") == 2, across).otherwise(none)).alias("_increase"),
        F.min("_s.t0").alias("_t0"), F.max("_s.t1").alias("_t1"), F.sum("_s.n").alias("n_samples"),
    )
    seconds = (F.col("_t1") - F.col("_t0")) / F.lit(MICROS)
    enough = F.col("n_samples") > 1
    return summed.select(
        *series, from_micros(F.col("_end") * us).alias("window_end"),
        F.when(enough, F.col("_increase")).alias("increase"),
        F.when(enough & (seconds > 0), F.col("_increase") / seconds).alias("rate"),
        "n_samples",
    )


def counter_rate(samples: DataFrame, series: list[str], window: int, step: int, **kw) -> DataFrame:
    """(series…, window_end, rate)."""
    return counter_increase(samples, series, window, step, **kw).select(*series, "window_end", "rate")


def sum_rate(samples: DataFrame, series: list[str], by: list[str], window: int, step: int, **kw) -> DataFrame:
    """Sum of the series' rates by label and window."""
    rates = counter_rate(samples, series, window, step, **kw).filter(F.col("rate").isNotNull())
    return rates.groupBy(*by, "window_end").agg(F.sum("rate").alias("rate"))


def funnel(stages: dict[str, DataFrame]) -> DataFrame:
    """Rates of several pipeline stages under each other: (stage, …) by union."""
    parts = [df.select(F.lit(name).alias("stage"), *df.columns) for name, df in stages.items()]
    return reduce(DataFrame.unionByName, parts)


# -- lag and counts ----------------------------------------------------------

def consumer_lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """(group_id, topic, partition, lag): end offset minus committed offset, never negative.

    end_offsets(topic, partition, end_offset), committed(group_id, topic, partition,
    committed); both have one row per partition.
    """
    both = committed.join(end_offsets, ["topic", "partition"])
    lag = F.greatest(F.col("end_offset") - F.col("committed"), F.lit(0).cast("bigint"))
    return both.select("group_id", "topic", "partition", lag.alias("lag"))


def lag_by_topic(lag: DataFrame) -> DataFrame:
    return lag.groupBy("topic").agg(F.sum("lag").alias("lag"))


def max_lag(lag: DataFrame) -> DataFrame:
    return lag.agg(F.max("lag").alias("lag"))


def events_by_type(df: DataFrame) -> DataFrame:
    """(type, n_events): counts by topic, added up by metric type."""
    by_topic = df.groupBy("topic").agg(F.count("*").alias("n"))
    return by_topic.groupBy(topic_type(F.col("topic")).alias("type")).agg(F.sum("n").alias("n_events"))


def stream_counters(events: DataFrame, topic: str = "topic", kind: str = "kind") -> DataFrame:
    """(topic, produced, errors, pauses): running totals; works on a stream in update mode too."""
    return events.groupBy(topic).agg(
        F.count_if(F.col(kind) == "produced").alias("produced"),
        F.count_if(F.col(kind) == "error").alias("errors"),
        F.count_if(F.col(kind) == "pause").alias("pauses"),
    )


# -- conditions --------------------------------------------------------------

def threshold_state(value: Column, steps: list[tuple[float | None, str]]) -> Column:
    """Name of the highest step not above the value; the first step has no bound."""
    out = F.lit(steps[0][1])
    for bound, name in steps[1:]:
        out = F.when(value >= bound, F.lit(name)).otherwise(out)
    return F.when(value.isNotNull(), out)


LAG_STEPS = [(None, "green"), (500, "orange"), (1000, "red")]
SWITCH_STEPS = [(None, "off"), (1, "on")]


def alert_intervals(
    vector: DataFrame, series: list[str], threshold: float, hold: int, step: int, tick: str = "tick",
    value: str = "value",
) -> DataFrame:
    """(series…, started_at, last_true_at, n_ticks, fired_at): runs of ticks with value > threshold.

    `fired_at` is the first tick at which the condition has held for `hold` seconds,
    NULL if it did not. A missing tick ends a run. Input is an instant vector: one
    row per series and tick, whatever the number of samples behind it; its size per
    series is the time span divided by `step`.
    """
    if not series:
        raise ValueError("name at least one series column (the rule's name will do)")
    w = Window.partitionBy(*series).orderBy("_t")
    run = F.col("_t") - F.row_number().over(w)
    true_ticks = vector.filter(F.col(value) > threshold).select(
        *series, cell(micros(F.col(tick)), step * MICROS).alias("_t")
    )
    runs = true_ticks.withColumn("_run", run).groupBy(*series, "_run").agg(
        F.min("_t").alias("_a"), F.max("_t").alias("_b"), F.count("*").alias("n_ticks")
    )
    held = -(-hold // step)
    at = lambda c: from_micros(c * (step * MICROS))
    return runs.select(
        *series, at(F.col("_a")).alias("started_at"), at(F.col("_b")).alias("last_true_at"), "n_ticks",
        F.when(F.col("_b") - F.col("_a") >= held, at(F.col("_a") + held)).alias("fired_at"),
    )


# The alert rules, (threshold, hold seconds).
ALERT_RULES = {"job_restarts": (0, 300), "consumer_lag_high": (1000, 300), "backpressure_active": (0, 120)}
EVALUATION_STEP = 60


def alert_rules(vectors: dict[str, DataFrame], series: list[str], stretch: int = 1, **kw) -> DataFrame:
    """(rule, series…, started_at, last_true_at, n_ticks, fired_at): the rules in `ALERT_RULES`, each over its instant vector.

    Rules are evaluated every `EVALUATION_STEP` seconds. `stretch` multiplies step and hold for sparser vectors.
    """
    parts = []
    for rule, vector in vectors.items():
        threshold, hold = ALERT_RULES[rule]
        found = alert_intervals(vector, series, threshold, hold * stretch, EVALUATION_STEP * stretch, **kw)
        parts.append(found.select(F.lit(rule).alias("rule"), *found.columns))
    return reduce(DataFrame.unionByName, parts)
