"""Registry of runnable queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartstream.schemas import table
from cartstream.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# The input tables that are used, with their declared schemas: nothing is inferred.
INPUTS = {
    "region": table("r_regionkey int, r_name string"),
    "customer": table("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "part": table("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    "orders": table(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": table(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": table(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


class Tables:
    """The input tables of one folder, as frames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            reader = self.spark.read.schema(INPUTS[name]) if name in INPUTS else self.spark.read
            self._frames[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`, with its SQL counterpart if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
