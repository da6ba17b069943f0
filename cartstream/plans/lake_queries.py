"""Queries for exploration, metrics and table upkeep."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.operators import burst, deep_pages, explorer, maintain, metrics, offsets
from cartstream.operators import ingest
from cartstream.plans import adapters as a
from cartstream.plans.event_queries import SQL_ORDER_DETAILS, VARIANTS
from cartstream.plans.registry import query
from cartstream.session import checkpoint_dir, unsorted_writes

ORDERS = f"({SQL_ORDER_DETAILS})"
RANGE = {"gte": "1997-01-01T00:00:00", "lte": "1998-06-30T23:59:59"}
IN_RANGE = "created_at BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1998-06-30 23:59:59'"


def orders(t):
    return ingest.to_order_details(a.raw_order_details(t))


# -- explorer ----------------------------------------------------------------

@query("filter_contains", "SELECT c_custkey, c_name FROM customer WHERE contains(lower(c_name), '#0000000') AND contains(CAST(c_custkey AS VARCHAR), '1')")
def filter_contains(t):
    spec = {"c_name": "#0000000", "c_custkey": "1", "c_mktsegment": "  ", "no_such": "x"}
    return explorer.filter_contains(t["customer"], spec).select("c_custkey", "c_name")


@query("filter_range", f"SELECT event_id, created_at FROM {ORDERS} WHERE {IN_RANGE}")
def filter_range(t):
    return explorer.filter_range(orders(t), "created_at", **RANGE).select("event_id", "created_at")


PAGE = {"created_at": RANGE, "vendor": "SUPPLIER 1"}
SQL_PAGE = f"{IN_RANGE} AND contains(lower(vendor), 'supplier 1')"


@query("explorer_page", f"""
SELECT event_id, id, vendor, price, created_at FROM {ORDERS} WHERE {SQL_PAGE} ORDER BY price DESC, event_id LIMIT 50 OFFSET 100""")
def explorer_page(t):
    return explorer.page(orders(t), PAGE, "price", "desc", 3, 50, ("event_id",)).select(
        "event_id", "id", "vendor", "price", "created_at")


@query("explorer_page_after", f"""
SELECT event_id, price FROM {ORDERS} WHERE {SQL_PAGE} AND price < 50000 ORDER BY price DESC, event_id LIMIT 50""")
def explorer_page_after(t):
    last = {"price": 50000, "event_id": "~"}
    return explorer.page_after(orders(t), last, "price", "desc", 50, PAGE, "event_id").select("event_id", "price")


@query("explorer_totals", f"""
SELECT count(*) AS total, CAST(ceil(count(*) / 50.0) AS BIGINT) AS total_pages FROM {ORDERS} WHERE {SQL_PAGE}""")
def explorer_totals(t):
    return explorer.page_totals(orders(t), PAGE, 50)


@query("table_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def table_preview(t):
    return explorer.preview(t["orders"], 10, ("o_orderkey",))


NULLED = "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END"


@query("explorer_page_after_nulls", f"""
SELECT c_custkey, segment, (row_number() OVER (ORDER BY segment DESC NULLS LAST, c_custkey) - 1) // ((count(*) OVER () + 4) // 5) AS page
FROM (SELECT c_custkey, {NULLED} AS segment FROM customer)""")
def explorer_page_after_nulls(t):
    """All rows in five pages, each found from the last row of the one before; NULLs come last."""
    people = t["customer"].selectExpr("c_custkey", f"{NULLED} AS segment")
    size, last, pages = max(1, -(-people.count() // 5)), None, []
    for number in range(5):
        page = explorer.page_after(people, last, "segment", "desc", size, tiebreak="c_custkey")
        pages.append(page.withColumn("page", F.lit(number).cast("bigint")))
        end = page.orderBy(F.col("segment").asc_nulls_first(), F.col("c_custkey").desc()).first()
        if end is None:
            break
        last = end.asDict()
    return reduce(DataFrame.unionByName, pages)


DEEP = "(SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_orderpriority DESC, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)"


@query("explorer_deep_pages", f"""
SELECT o_orderkey, o_orderpriority, pos // 50 + 1 AS page FROM {DEEP} WHERE pos // 50 IN (0, n // 100, (n - 1) // 50)""")
def explorer_deep_pages(t):
    """The first, a middle and the last page of all orders by priority, of which there are five."""
    path = f"{checkpoint_dir(t.spark)}/deep-pages/{uuid.uuid4()}"
    listing = t["orders"].select("o_orderkey", "o_orderpriority")
    index = deep_pages.PageIndex(t.spark, path, "o_orderpriority", "desc", ("o_orderkey",)).build(listing, bucket_rows=5000)
    total = index.total()
    numbers = sorted({1, total // 100 + 1, max(total - 1, 0) // 50 + 1})
    return reduce(DataFrame.unionByName, [index.page(k).withColumn("page", F.lit(k).cast("bigint")) for k in numbers])


COUNTED = ("part", "customer", "orders", "lineitem", "events")


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in COUNTED
) + " UNION ALL SELECT 'no_such_table', 0")
def table_counts(t):
    frames = {n: explorer.readable(lambda n=n: t[n]) for n in (*COUNTED, "no_such_table")}
    return explorer.table_counts(frames).drop("error")


READ_ONLY = """
WITH spend AS (SELECT o_custkey, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM {orders} GROUP BY o_custkey)
SELECT c_mktsegment, count(*) AS customers, CAST(sum(n_orders) AS BIGINT) AS n_orders, CAST(sum(spent) AS DECIMAL(28,2)) AS spent
FROM {customer} JOIN spend ON o_custkey = c_custkey GROUP BY c_mktsegment"""


@query("read_only_sql", READ_ONLY.format(orders="orders", customer="customer"))
def read_only_sql(t):
    return explorer.read_only_sql(
        t.spark, READ_ONLY.format(orders="ro_orders", customer="ro_customer"),
        {"ro_orders": t["orders"], "ro_customer": t["customer"]},
    )


# -- metrics -----------------------------------------------------------------

SAMPLES = f"({a.sql_frame(a.SAMPLES, 'events')})"
HOUR = 3600
LABELS = ["topic", "host"]
SERIES = ["metric", *LABELS]


@query("select_series", f"SELECT ts, topic, host, counter AS value FROM {SAMPLES} WHERE metric = 'events_produced_total' AND regexp_full_match(topic, 'shopify[.].*r.*') AND host = 'host-1'")
def select_series(t):
    out = metrics.select_series(a.samples(t), {"topic": "shopify[.].*r.*"}, {"host": "host-1"}, "events_produced_total")
    return metrics.with_labels(out, ["topic", "host"]).select("ts", "topic", "host", "value")


@query("last_interval", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 11:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'")
def last_interval(t):
    return explorer.last_interval(t["events"], "ts", "1 hour", "2024-01-20 12:00:00").select("event_id", "ts")


def instant_sql(value: str, step: int, lookback: int) -> str:
    """Newest sample at each tick by an as-of join over a full tick grid per series."""
    return f"""(
SELECT g.metric, g.topic, g.host, g.tick, s.value FROM (
  SELECT metric, topic, host, unnest(generate_series(lo, hi, INTERVAL {step} SECOND)) AS tick FROM (
    SELECT metric, topic, host, to_timestamp(ceil(epoch(min(ts)) / {step}) * {step})::TIMESTAMP AS lo,
           to_timestamp((floor(epoch(max(ts)) / {step}) + {lookback // step + 1}) * {step})::TIMESTAMP AS hi
    FROM {SAMPLES} GROUP BY ALL)) g
ASOF JOIN (SELECT metric, topic, host, ts, {value} AS value FROM {SAMPLES}) s ON s.metric = g.metric AND s.topic = g.topic AND s.host = g.host AND s.ts <= g.tick
WHERE g.tick - s.ts < INTERVAL {lookback} SECOND)"""


def gauge_vector(t, step=HOUR, lookback=6 * HOUR, value="gauge"):
    return metrics.instant_vector(
        metrics.with_labels(a.samples(t, value), LABELS), SERIES, step, lookback)


@query("instant_vector", f"SELECT * FROM {instant_sql('gauge', HOUR, 6 * HOUR)}")
def instant_vector(t):
    return gauge_vector(t)


@query("sum_gauge", f"SELECT topic, tick, sum(value) AS value FROM {instant_sql('gauge', HOUR, 6 * HOUR)} GROUP BY ALL")
def sum_gauge(t):
    return metrics.sum_gauge(gauge_vector(t), ["topic", "tick"])


@query("latest_values", f"SELECT metric, topic, host, arg_max(gauge, ts) AS value FROM {SAMPLES} GROUP BY ALL")
def latest_values(t):
    return metrics.latest_values(metrics.with_labels(a.samples(t, "gauge"), LABELS), SERIES)


@query("sum_all", f"SELECT sum(value) AS value FROM (SELECT arg_max(gauge, ts) AS value FROM {SAMPLES} GROUP BY metric, topic, host)")
def sum_all(t):
    return metrics.sum_all(latest_values(t))


@query("threshold_state", f"""
SELECT metric, topic, host, tick, CASE WHEN value >= 1000 THEN 'red' WHEN value >= 500 THEN 'orange' ELSE 'green' END AS state,
       CASE WHEN value >= 1 THEN 'on' ELSE 'off' END AS switch
FROM (SELECT * REPLACE (value / 5 AS value) FROM {instant_sql('gauge', HOUR, 6 * HOUR)})""")
def threshold_state(t):
    v = F.col("value") / 5
    return gauge_vector(t).select(
        *SERIES, "tick", metrics.threshold_state(v, metrics.LAG_STEPS).alias("state"),
        metrics.threshold_state(v, metrics.SWITCH_STEPS).alias("switch"))


def windows_sql(window: int, step: int) -> str:
    """Samples joined with every window [end - window, end) they fall in, growth inside each by lag."""
    return f"""(
SELECT metric, topic, host, window_end, CASE WHEN count(*) > 1 THEN sum(gain) END AS increase, count(*) AS n_samples,
       CASE WHEN count(*) > 1 AND max(us) > min(us) THEN sum(gain) / ((max(us) - min(us)) / 1000000.0::DOUBLE) END AS rate
FROM (
  SELECT metric, topic, host, window_end, us, CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END AS gain FROM (
    SELECT *, lag(v) OVER (PARTITION BY metric, topic, host, window_end ORDER BY us) AS p FROM (
      SELECT metric, topic, host, counter AS v, epoch_us(ts) AS us,
             unnest(generate_series(epoch_us(ts) // {step * 1000000} + 1, (epoch_us(ts) + {window * 1000000}) // {step * 1000000})) AS k,
             to_timestamp(k * {step})::TIMESTAMP AS window_end
      FROM {SAMPLES})))
GROUP BY ALL)"""


def counters(t):
    return metrics.with_labels(a.samples(t), LABELS)


@query("counter_increase", f"SELECT metric, topic, host, window_end, increase, n_samples FROM {windows_sql(6 * HOUR, HOUR)}")
def counter_increase(t):
    return metrics.counter_increase(counters(t), SERIES, 6 * HOUR, HOUR).drop("rate")


@query("counter_rate", f"SELECT metric, topic, host, window_end, round(rate, 9) AS rate FROM {windows_sql(6 * HOUR, 6 * HOUR)}")
def counter_rate(t):
    return metrics.counter_rate(counters(t), SERIES, 6 * HOUR, 6 * HOUR).withColumn("rate", F.round("rate", 9))


@query("counter_rate_uneven", f"SELECT metric, topic, host, window_end, round(rate, 9) AS rate FROM {windows_sql(10 * HOUR, 4 * HOUR)}")
def counter_rate_uneven(t):
    return metrics.counter_rate(counters(t), SERIES, 10 * HOUR, 4 * HOUR).withColumn("rate", F.round("rate", 9))


@query("counter_rate_coprime", f"SELECT metric, topic, host, window_end, n_samples, round(rate, 9) AS rate FROM {windows_sql(7 * HOUR + 1, 5 * HOUR)}")
def counter_rate_coprime(t):
    """Window and step share no divisor but a second."""
    out = metrics.counter_increase(counters(t), SERIES, 7 * HOUR + 1, 5 * HOUR)
    return out.select(*SERIES, "window_end", "n_samples", F.round("rate", 9).alias("rate"))


@query("sum_rate", f"SELECT topic, window_end, round(sum(rate), 6) AS rate FROM {windows_sql(6 * HOUR, HOUR)} WHERE rate IS NOT NULL GROUP BY ALL")
def sum_rate(t):
    return metrics.sum_rate(counters(t), SERIES, ["topic"], 6 * HOUR, HOUR).withColumn("rate", F.round("rate", 6))


def stage_sql(stage: str, test: str) -> str:
    """One stage's rate: the rates of its series, added up by topic."""
    inner = windows_sql(12 * HOUR, 12 * HOUR).replace(SAMPLES, f"(SELECT * FROM {SAMPLES} WHERE {test})")
    return f"SELECT '{stage}' AS stage, topic, window_end, round(sum(rate), 6) AS rate FROM {inner} WHERE rate IS NOT NULL GROUP BY ALL"


STAGES = {"produced": "metric = 'events_produced_total'", "consumed": "metric = 'events_consumed_total'", "committed": "host = 'host-0'"}


@query("funnel", " UNION ALL ".join(stage_sql(n, c) for n, c in STAGES.items()))
def funnel(t):
    rows = metrics.with_labels(a.samples(t), LABELS)
    stages = {
        n: metrics.sum_rate(rows.filter(c), SERIES, ["topic"], 12 * HOUR, 12 * HOUR).withColumn("rate", F.round("rate", 6))
        for n, c in STAGES.items()
    }
    return metrics.funnel(stages)


def lag_frames(t):
    rows = t["events"].selectExpr(*a.select_list(a.OFFSETS)).withColumnRenamed("part", "partition")
    ends = rows.groupBy("topic", "partition").agg((F.max("position") + 1).alias("end_offset"))
    done = rows.filter("position % 10 > 4").groupBy("group_id", "topic", "partition").agg(F.max("position").alias("committed"))
    return ends, done


SQL_LAG = f"""(
SELECT group_id, topic, part AS "partition", greatest(end_offset - committed, 0) AS lag
FROM (SELECT group_id, topic, part, max(position) AS committed FROM ({a.sql_frame(a.OFFSETS, 'events')}) WHERE position % 10 > 4 GROUP BY ALL)
JOIN (SELECT topic, part, max(position) + 1 AS end_offset FROM ({a.sql_frame(a.OFFSETS, 'events')}) GROUP BY ALL) USING (topic, part))"""


@query("consumer_lag", f"SELECT * FROM {SQL_LAG}")
def consumer_lag(t):
    return metrics.consumer_lag(*lag_frames(t))


@query("lag_by_topic", f"SELECT topic, CAST(sum(lag) AS BIGINT) AS lag FROM {SQL_LAG} GROUP BY ALL")
def lag_by_topic(t):
    return metrics.lag_by_topic(consumer_lag(t))


@query("max_lag", f"SELECT max(lag) AS lag FROM {SQL_LAG}")
def max_lag(t):
    return metrics.max_lag(consumer_lag(t))


@query("events_by_type", f"""
SELECT regexp_replace(split_part(topic, '/', 1), 's$', '') AS type, count(*) AS n_events
FROM (SELECT {a.TOPIC_BY_EVENT} AS topic FROM events) GROUP BY 1""")
def events_by_type(t):
    return metrics.events_by_type(t["events"].selectExpr(f"{a.TOPIC_BY_EVENT} AS topic"))


KIND = "CASE WHEN event_id % 10 = 0 THEN 'error' WHEN event_id % 50 = 1 THEN 'pause' ELSE 'produced' END"


@query("stream_counters", f"""
SELECT event_type AS topic, count(*) FILTER (kind = 'produced') AS produced, count(*) FILTER (kind = 'error') AS errors,
       count(*) FILTER (kind = 'pause') AS pauses FROM (SELECT event_type, {KIND} AS kind FROM events) GROUP BY 1""")
def stream_counters(t):
    return metrics.stream_counters(t["events"].selectExpr("event_type AS topic", f"{KIND} AS kind"))


def alert_sql(vector: str, series: str, threshold: float, hold: int, step: int) -> str:
    held = -(-hold // step)
    return f"""
SELECT {series}, to_timestamp(a * {step})::TIMESTAMP AS started_at, to_timestamp(b * {step})::TIMESTAMP AS last_true_at, n_ticks,
       CASE WHEN b - a >= {held} THEN to_timestamp((a + {held}) * {step})::TIMESTAMP END AS fired_at
FROM (SELECT {series}, min(k) AS a, max(k) AS b, count(*) AS n_ticks FROM (
  SELECT {series}, k, k - row_number() OVER (PARTITION BY {series} ORDER BY k) AS run FROM (
    SELECT {series}, CAST(epoch(tick) AS BIGINT) // {step} AS k FROM {vector} WHERE value > {threshold})) GROUP BY {series}, run)"""


@query("alert_intervals", alert_sql(instant_sql("gauge", HOUR, 6 * HOUR), "metric, topic, host", 4000, 2 * HOUR, HOUR))
def alert_intervals(t):
    return metrics.alert_intervals(gauge_vector(t), SERIES, 4000, 2 * HOUR, HOUR)


@query("alert_restarts", alert_sql(
    f"(SELECT metric, topic, host, window_end AS tick, increase AS value FROM {windows_sql(6 * HOUR, HOUR)})", "metric, topic, host", 50, 3 * HOUR, HOUR))
def alert_restarts(t):
    """The rule on a counter: growth over a sliding window above a bound, held for three hours."""
    vector = metrics.counter_increase(counters(t), SERIES, 6 * HOUR, HOUR)
    return metrics.alert_intervals(vector, SERIES, 50, 3 * HOUR, HOUR, tick="window_end", value="increase")


RULES = {"job_restarts": 50, "consumer_lag_high": 1, "backpressure_active": 3000}


@query("alert_rules", " UNION ALL ".join(
    "SELECT '{0}' AS rule, * FROM ({1})".format(rule, alert_sql(
        "(SELECT * REPLACE (value - {0} AS value) FROM {1})".format(less, instant_sql("gauge", HOUR, 6 * HOUR)),
        "metric, topic, host", metrics.ALERT_RULES[rule][0], 60 * metrics.ALERT_RULES[rule][1], HOUR))
    for rule, less in RULES.items()))
def alert_rules(t):
    """The three rules with their thresholds and holds, an hour of the sparse test samples for a minute."""
    vector = gauge_vector(t)
    shifted = {rule: vector.withColumn("value", F.col("value") - less) for rule, less in RULES.items()}
    return metrics.alert_rules(shifted, SERIES, stretch=60)


# Errors of the test stream are minutes apart, so the windows are scaled up.
BURST_WINDOW = 2 * HOUR


SQL_MESSAGES = "SELECT event_type AS topic, event_id % 3 AS partition, event_id // 3 AS message_offset, value FROM events"


def _messages(t):
    return t["events"].selectExpr("event_type AS topic", "event_id % 3 AS partition", "event_id div 3 AS message_offset", "value")


@query("offset_gaps", f"""
WITH m AS (SELECT DISTINCT topic, partition, message_offset FROM ({SQL_MESSAGES}) WHERE value > 5),
runs AS (SELECT *, message_offset - row_number() OVER (PARTITION BY topic, partition ORDER BY message_offset) AS run FROM m),
islands AS (SELECT topic, partition, min(message_offset) AS first_offset, max(message_offset) AS last_offset FROM runs GROUP BY topic, partition, run)
SELECT *, lead(first_offset) OVER (PARTITION BY topic, partition ORDER BY first_offset) - last_offset - 1 AS missing_after FROM islands""")
def offset_gaps(t):
    """Consumed offsets per topic and partition as intervals, with the gaps after them."""
    keys = ["topic", "partition"]
    return offsets.gaps(offsets.islands(_messages(t).filter("value > 5"), keys, "message_offset", width=1000), keys)


@query("offset_replay", f"""
SELECT topic, partition, message_offset, value FROM ({SQL_MESSAGES})
WHERE (topic, partition, message_offset) NOT IN (SELECT (topic, partition, message_offset) FROM ({SQL_MESSAGES}) WHERE value > 5)""")
def offset_replay(t):
    """A replay of all messages: those the consumed intervals do not hold."""
    keys = ["topic", "partition"]
    return offsets.not_consumed(_messages(t), offsets.islands(_messages(t).filter("value > 5"), keys, "message_offset"), keys, "message_offset", width=1000)


@query("error_burst", f"""
SELECT topic, ts, n_window, n_window >= 5 AS burst FROM (
  SELECT event_type AS topic, ts, count(*) OVER (PARTITION BY event_type ORDER BY ts
         RANGE BETWEEN INTERVAL {BURST_WINDOW} SECOND PRECEDING AND CURRENT ROW) AS n_window
  FROM events WHERE value > 20)""")
def error_burst(t):
    errors = t["events"].filter("value > 20").select(F.col("event_type").alias("topic"), "ts")
    return burst.error_burst(errors, ["topic"], "ts", BURST_WINDOW, 5)


@query("pause_intervals", f"""
WITH RECURSIVE ticks AS (
  SELECT event_type AS topic, ts, count(*) FILTER (value > 20) AS n FROM events GROUP BY ALL),
tested AS (
  SELECT topic, ts, sum(n) OVER (PARTITION BY topic ORDER BY ts
         RANGE BETWEEN INTERVAL {BURST_WINDOW} SECOND PRECEDING AND CURRENT ROW) AS n_window FROM ticks),
starts AS (
  SELECT c.topic, c.ts AS paused_at, c.ts + INTERVAL 1 HOUR AS resumes_at, t.ts AS resumed_tick
  FROM (SELECT *, ts + INTERVAL 1 HOUR AS until FROM tested WHERE n_window >= 5) c
  ASOF LEFT JOIN ticks t ON t.topic = c.topic AND t.ts >= c.until),
hops AS (
  SELECT s.*, n.paused_at AS next_at FROM starts s
  ASOF LEFT JOIN starts n ON n.topic = s.topic AND n.paused_at > s.resumed_tick),
chain AS (
  SELECT * FROM hops WHERE (topic, paused_at) IN (SELECT (topic, min(paused_at)) FROM hops GROUP BY topic)
  UNION ALL
  SELECT h.* FROM chain c JOIN hops h ON h.topic = c.topic AND h.paused_at = c.next_at)
SELECT topic, paused_at, resumes_at, resumed_tick FROM chain""")
def pause_intervals(t):
    """Pauses per topic; which tick pauses depends on the pause before."""
    ticks = t["events"].select(F.col("event_type").alias("topic"), "ts", (F.col("value") > 20).alias("is_error"))
    return burst.pause_intervals(ticks, ["topic"], "is_error", "ts", BURST_WINDOW, 5, HOUR)


# -- upkeep ------------------------------------------------------------------

FILES = f"({a.sql_frame(a.FILES, 'events')})"
SQL_PLAN = f"""(
SELECT table_name, part, file_path, size_bytes,
       CAST((sum(size_bytes) OVER (PARTITION BY table_name, part ORDER BY file_path) - size_bytes) // 134217728 AS BIGINT) AS bin
FROM {FILES})"""


@query("plan_compaction", f"SELECT * FROM {SQL_PLAN}")
def plan_compaction(t):
    files = t["events"].selectExpr(*a.select_list(a.FILES))
    return maintain.plan_compaction(files, ["table_name", "part"])


@query("compaction_groups", f"""
SELECT table_name, part, bin, count(*) AS n_files, CAST(sum(size_bytes) AS BIGINT) AS size_bytes FROM {SQL_PLAN} GROUP BY ALL""")
def compaction_groups(t):
    return maintain.compaction_groups(plan_compaction(t), ["table_name", "part"])


@query("compact_rewrite", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem")
def compact_rewrite(t):
    """A table in many small files rewritten at a new place; the rows must be the same."""
    root = f"{checkpoint_dir(t.spark)}/cartstream/{uuid.uuid4()}"
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    with unsorted_writes(t.spark):
        rows.repartition(24).write.mode("overwrite").partitionBy("l_returnflag").parquet(f"{root}/small")
    maintain.rewrite(t.spark, f"{root}/small", f"{root}/big", ["l_returnflag"])
    return t.spark.read.parquet(f"{root}/big")


@query("expired_snapshots", """
SELECT table_name, snapshot_id, committed_at FROM (
  SELECT event_type AS table_name, event_id AS snapshot_id, ts AS committed_at,
         row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn > 5 AND committed_at < TIMESTAMP '2024-01-29 23:00:00'""")
def expired_snapshots(t):
    snapshots = t["events"].selectExpr(*a.select_list(a.SNAPSHOTS))
    return maintain.expired_snapshots(snapshots, "2024-01-30 00:00:00").select("table_name", "snapshot_id", "committed_at")


@query("read_partition", f"""
SELECT product_id % 8 AS location_id, count(*) AS n_rows, CAST(sum(inventory_quantity) AS BIGINT) AS quantity
FROM {VARIANTS} WHERE product_id % 8 = 2 GROUP BY ALL""")
def read_partition(t):
    """A table written by location, and one location of it read back; the other folders are not touched."""
    path = f"{checkpoint_dir(t.spark)}/cartstream/{uuid.uuid4()}"
    v = ingest.to_product_variants(a.raw_products(t, dealt=True)).withColumn("location_id", F.col("product_id") % 8)
    v.write.partitionBy("location_id").parquet(path)
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in v.schema if f.name != 'location_id')}, location_id bigint"
    one = t.spark.read.schema(schema).parquet(path).filter("location_id = 2")
    return one.groupBy("location_id").agg(F.count("*").alias("n_rows"), F.sum("inventory_quantity").alias("quantity"))
