"""Interactive reads: filters, pages, previews, counts, health, read-only SQL."""

from __future__ import annotations

import re
from datetime import UTC, datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartstream.functions import unix_floor

DATE_FIELDS = ("created_at", "updated_at")


# -- filters -----------------------------------------------------------------

def allowed_columns(df: DataFrame) -> list[str]:
    """Columns a caller may filter and sort by: those the table really has."""
    return list(df.columns)


def table_named(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """The table of that name; an unknown one is an error."""
    if name not in tables:
        raise ValueError(f"there is no table named {name!r} here")
    return tables[name]


def contains_predicate(column: str, text: str) -> Column:
    """Case-insensitive substring; % and _ are ordinary characters."""
    return F.contains(F.lower(F.col(column).cast("string")), F.lower(F.lit(text)))


def _moment(value) -> datetime | None:
    if isinstance(value, datetime):
        return value
    try:
        return datetime.fromisoformat(str(value))
    except ValueError:
        return None


def literal(value, kind: str, collected: bool = False) -> Column:
    """A value as a literal of a column type. Times pass as text, so the driver's own time zone plays no part.

    Only a `collected` instant is in that zone: rows reach Python as local times.
    """
    if not isinstance(value, datetime):
        return F.lit(value)
    if kind == "timestamp":
        value = value.astimezone(UTC) if collected else value
    elif value.tzinfo is not None:
        value = value.astimezone(UTC).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast(kind)


def range_predicate(column: str, gte, lte, kind: str = "timestamp_ntz") -> Column | None:
    """Closed range on a date column of type `kind`; None when it does not apply or an end does not parse."""
    low, high = _moment(gte), _moment(lte)
    if column not in DATE_FIELDS or low is None or high is None:
        return None
    return F.col(column).between(literal(low, kind), literal(high, kind))


def predicates(df: DataFrame, spec: dict) -> list[Column]:
    """Predicates of a filter spec {column: text | {'gte':…, 'lte':…}}.

    Unknown columns, blank texts and malformed ranges are ignored.
    """
    out = []
    for column, value in spec.items():
        if column not in allowed_columns(df):
            continue
        if isinstance(value, str):
            if value.strip():
                out.append(contains_predicate(column, value))
        elif isinstance(value, dict) and {"gte", "lte"} <= value.keys():
            p = range_predicate(column, value["gte"], value["lte"], df.schema[column].dataType.simpleString())
            if p is not None:
                out.append(p)
    return out


def apply_filters(df: DataFrame, spec: dict) -> DataFrame:
    """All filters of the spec together; no filters, no WHERE."""
    ps = predicates(df, spec)
    return df.filter(reduce(lambda a, b: a & b, ps)) if ps else df


def filter_contains(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    return apply_filters(df, spec)


def filter_range(df: DataFrame, column: str, gte, lte) -> DataFrame:
    return apply_filters(df, {column: {"gte": gte, "lte": lte}})


def last_interval(df: DataFrame, ts: str, interval: str, now) -> DataFrame:
    """Rows after `now` - interval, up to `now`. `now` is a parameter, so reruns agree."""
    end = F.lit(now).cast("timestamp_ntz")
    return df.filter((F.col(ts) > end - F.expr(f"interval {interval}")) & (F.col(ts) <= end))


# -- pages -------------------------------------------------------------------

def sort_columns(df: DataFrame, sort_by: str | None, order: str, tiebreak: list[str]) -> list[Column]:
    """Sort by an allowed column, then by the tie-break; by the tie-break only otherwise."""
    cols = []
    if sort_by in allowed_columns(df):
        cols.append(F.col(sort_by).asc() if order == "asc" else F.col(sort_by).desc())
    return cols + [F.col(c) for c in tiebreak if c != sort_by]


def page(
    df: DataFrame, filters: dict | None = None, sort_by: str | None = None, order: str = "desc",
    page: int = 1, limit: int = 50, tiebreak: tuple[str, ...] = ("id",),
) -> DataFrame:
    """One page of the filtered, sorted rows (pages count from 1).

    The cost of an offset grows with it; use `page_after` to walk deep.
    """
    rows = apply_filters(df, filters or {})
    return rows.orderBy(*sort_columns(df, sort_by, order, list(tiebreak))).offset((page - 1) * limit).limit(limit)


def page_after(
    df: DataFrame, last: dict | None, sort_by: str, order: str = "desc", limit: int = 50,
    filters: dict | None = None, tiebreak: str = "id",
) -> DataFrame:
    """The page after the row `last` (its `sort_by` and `tiebreak` values), by key instead of offset.

    The predicate reaches the scan and the sort is a top-k, so page 10,000 costs
    what page 1 costs. NULLs are listed as `page` lists them: first in ascending order, last in
    descending order, and among themselves by the tie-break, which must not be NULL.
    """
    rows = apply_filters(df, filters or {})
    if last is not None:
        kinds = {f.name: f.dataType.simpleString() for f in df.schema}
        own, tie = F.col(sort_by), F.col(tiebreak) > literal(last[tiebreak], kinds[tiebreak], collected=True)
        if last[sort_by] is None:
            after = own.isNull() & tie
            rows = rows.filter(after | own.isNotNull() if order == "asc" else after)
        else:
            s = literal(last[sort_by], kinds[sort_by], collected=True)
            after = (own > s if order == "asc" else own < s) | ((own == s) & tie)
            rows = rows.filter(after if order == "asc" else after | own.isNull())
    return rows.orderBy(*sort_columns(df, sort_by, order, [tiebreak])).limit(limit)


def page_totals(df: DataFrame, filters: dict | None = None, limit: int = 50) -> DataFrame:
    """(total, total_pages) for the same filters."""
    total = F.count("*").alias("total")
    return apply_filters(df, filters or {}).agg(total).select(
        "total", F.ceil(F.col("total") / F.lit(limit)).cast("bigint").alias("total_pages")
    )


def recent_events(df: DataFrame, n: int = 50, ts: str = "created_at", tiebreak: str = "id") -> DataFrame:
    """Newest n rows: a top-k per partition, then of the k's."""
    return df.orderBy(F.col(ts).desc(), F.col(tiebreak)).limit(n)


def last_event(df: DataFrame, ts: str = "created_at", tiebreak: str = "id") -> DataFrame:
    """The single newest row."""
    return recent_events(df, 1, ts, tiebreak)


def preview(df: DataFrame, n: int = 10, order: tuple[str, ...] = ()) -> DataFrame:
    """Any n rows, or the first n by `order`."""
    return (df.orderBy(*order) if order else df).limit(n)


# -- counts and health -------------------------------------------------------

def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table_name, n_rows, error), one row per table; a table that cannot be opened (None) or read counts 0.

    Eager: one count per table, which reads no column (row counts come from the Parquet footers), so a table that
    fails spoils no other count. `error` says why a table was not counted.
    """
    rows = []
    for name, df in tables.items():
        try:
            rows.append((name, df.count(), None) if df is not None else (name, 0, "cannot be opened"))
        except (PySparkException, Py4JJavaError) as exc:
            rows.append((name, 0, str(exc)))
    return SparkSession.active().createDataFrame(rows, "table_name string, n_rows bigint, error string")


def readable(load) -> DataFrame | None:
    """The frame `load()` gives, or None when the table cannot be opened."""
    try:
        return load()
    except PySparkException:
        return None


def event_health(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """(total, last_event_unix, healthy); the time is 0 and healthy false on an empty table."""
    return df.agg(F.count("*").alias("total"), F.max(ts).alias("_last")).select(
        "total", unix_floor(F.col("_last")).alias("last_event_unix"),
        F.col("_last").isNotNull().alias("healthy"),
    )


# -- SQL ---------------------------------------------------------------------

_COMMENTS = re.compile(r"--[^\n]*|/\*.*?\*/", re.S)
_LITERALS = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`", re.S)

# Functions that call into the JVM, and tables named by their path, reach beyond the tables on offer.
_REACHES = re.compile(r"\b(try_reflect|reflect|java_method)\s*\(", re.I)
_PATH_TABLE = re.compile(r"\b[A-Za-z_]\w*\s*\.\s*`[^`]*[/:][^`]*`")

_WRITES = re.compile(
    r"\binsert\s+(into|overwrite)\b|\bmerge\s+into\b|\bdelete\s+from\b|\bupdate\s+\S+(\s+\S+){0,2}\s+set\b",
    re.I,
)


class NotReadOnly(ValueError):
    """The statement is not a single SELECT or WITH query."""


def assert_read_only(sql: str) -> None:
    """Refuse anything but one statement that starts with SELECT or WITH.

    A look at the text only; what the query means is left to Spark. The statements
    that change data and may follow a WITH clause are refused by their verbs.
    """
    unquoted = _LITERALS.sub(lambda m: m.group(0) if m.group(0).startswith("`") else "''", sql)
    bare = _COMMENTS.sub(" ", unquoted).strip().rstrip(";").strip()
    first = re.match(r"[A-Za-z]+", bare)
    if not first or first.group(0).upper() not in ("SELECT", "WITH"):
        raise NotReadOnly("the statement must begin with SELECT or WITH")
    if ";" in bare:
        raise NotReadOnly("the text holds several statements")
    if _WRITES.search(bare):
        raise NotReadOnly("the statement changes data")
    if _REACHES.search(bare.replace("`", "")):
        raise NotReadOnly("the statement calls into the JVM")
    if _PATH_TABLE.search(_COMMENTS.sub(" ", sql)):
        raise NotReadOnly("the statement reads files by their path")


_RELATION = re.compile(r"UnresolvedRelation \[(.*?)\], \[")
_COMMON_TABLES = re.compile(r"CTE \[(.*?)\]")


def assert_known_relations(spark: SparkSession, sql: str, tables: list[str]) -> None:
    """Refuse a query that names a relation other than `tables` and its own common tables, however it is quoted.

    The names are those of the parsed plan, subqueries included. A file read by its path is a name of two parts.
    """
    tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).treeString()
    common = {name.strip() for names in _COMMON_TABLES.findall(tree) for name in names.split(",")}
    known = {name.lower() for name in [*tables, *common]}
    for name in _RELATION.findall(tree):
        if name.lower() not in known:
            raise NotReadOnly(f"no table named {name} is on offer")


def read_only_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run one read-only query over `tables`, which are views while it is analysed; a view of the caller's is never replaced."""
    assert_read_only(sql)
    assert_known_relations(spark, sql, list(tables or {}))
    made = []
    try:
        for name, df in (tables or {}).items():
            df.createTempView(name)
            made.append(name)
        return spark.sql(sql)
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table_name, is_temporary) of the catalog."""
    rows = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return rows.select(F.col("tableName").alias("table_name"), F.col("isTemporary").alias("is_temporary"))


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    """(column_name, data_type) of one table, for completion."""
    rows = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema]
    return spark.createDataFrame(rows, "column_name string, data_type string")
