"""URL rules as a sort-merge range join over reversed-host keys. DataFrame functions only.

A rule (host, path) covers the keys that begin with "reversed host, separator, path": an interval from that key to the
key followed by a byte that no text holds. A url is looked up once for each of its host's suffixes. Rules and look-ups are
sorted by key together and swept: the number of open intervals is the depth of a stack of nested rules, and the top of the
stack is the newest start at the present depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """From the first '://' up to '/', '?', '#' or the end, A-Z in lower case; '' for null or without '://'."""
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end; '' for null or without '://'."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _reversed(labels: Column, n: Column) -> Column:
    return F.concat_ws(".", F.slice(F.reverse(labels), 1, n))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule (host and path of the winning rule, or null), verdict.

    `rules` has host, path and verdict. A rule fits its host and all subdomains when the url's path starts with its path;
    the longest wins (longer host before longer path). Of equal rules with different verdicts the alphabetically later verdict
    ('block') counts; rules with a null field are ignored. Without a rule the verdict is `default`. A null url, or one without
    '://', has an empty host and path and so no rule. Repeated rows each give a row; a null page_id stays null.

    A hot host is spread over `salts` copies of the rules; only suffixes as long as some rule's host are looked up.
    """
    spark = pages.sparkSession
    n = salts or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = (
        rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    )
    # One number: how many labels the longest rule host has.
    longest = known.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 0

    urls = pages.select(
        F.monotonically_increasing_id().alias("uid"), "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
    )
    labels = F.split("host", r"\.", -1)
    lookups = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size(labels), F.lit(longest)))), lambda m: _reversed(labels, m)
    )
    probes = urls.select(
        "uid", "page_id", "host", "path", F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int").alias("salt"), F.explode(lookups).alias("suffix"),
        F.encode("path", "utf-8").alias("key"), F.lit(0).alias("step"),
        F.lit(None).cast("struct<size:int,rule:string,verdict:string>").alias("found"),
    )
    opened = known.select(
        F.lit(None).cast("long").alias("uid"), F.lit(None).cast("long").alias("page_id"), F.lit("").alias("host"), F.lit("").alias("path"),
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("salt"),
        _reversed(F.split("host", r"\.", -1), F.lit(longest)).alias("suffix"),
        F.encode("path", "utf-8").alias("key"), F.lit(1).alias("step"),
        F.struct(
            F.length("path").alias("size"), F.concat("host", "path").alias("rule"), F.col("verdict")
        ).alias("found"),
    )
    closed = opened.withColumn("key", F.concat("key", F.lit(bytes([255])))).withColumn("step", F.lit(-1)).withColumn("found", F.lit(None))
    # Starts before look-ups of the same key; a longer key is a nested rule, so starts never tie.
    order = [F.col("key"), F.col("step").desc()]
    sweep = Window.partitionBy("suffix", "salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("suffix", "salt", "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        probes.unionByName(opened).unionByName(closed)
        .withColumn("depth", F.sum("step").over(sweep))
        .withColumn("top", F.last("found", ignorenulls=True).over(level))
        .filter("step = 0")
        .withColumn("top", F.when(F.col("depth") > 0, F.struct(F.length("suffix").alias("host_size"), "top.*")))
    )
    best = F.max("top")
    return (
        swept.groupBy("uid").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best"))
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    )
