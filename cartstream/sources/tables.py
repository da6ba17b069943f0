"""Lake tables: reading, creating, evolving.

Tables are Parquet folders `<root>/<table>`; with a table catalog configured the
same names resolve through it instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartstream.streaming.state import BatchLog


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A table by name: `<root>/<name>` as Parquet, or the catalog's table when no root is given.

    Tables that jobs write batch by batch are read as their rows, without the folders' numbers.
    """
    if root is None:
        return spark.table(name)
    path = f"{root.rstrip('/')}/{name}"
    batches = BatchLog(spark, path).read()
    return spark.read.parquet(path) if batches is None else batches


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
    partition_by: list[str] | None = None, props: dict[str, str] | None = None, replace: bool = False,
    provider: str = "parquet",
) -> None:
    """Create the table if it is missing. Existing data is only dropped with `replace`."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in (props or {}).items())
    options = f" TBLPROPERTIES ({pairs})" if pairs else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}{parts}{place}{options}")


def set_properties(spark: SparkSession, name: str, props: dict[str, str]) -> None:
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` in the shape of `schema`: missing columns are added as NULL, types are cast.

    Columns the schema does not name are kept at the end.
    """
    have = set(df.columns)
    named = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    extra = [F.col(c) for c in df.columns if c not in schema.names]
    return df.select(*named, *extra)


def append_evolved(parts: list[DataFrame]) -> DataFrame:
    """Rows of several generations of a table; columns absent in one are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
