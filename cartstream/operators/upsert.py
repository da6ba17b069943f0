"""Keyed current state as a mergeable fold.

A fold keeps, per key and column, the winning value *with the order value that
won*. Folding is associative and commutative, so

    fold(a + b) == merge(fold(a), fold(b))

for any split of the input into batches, whatever order they are merged in.
Merging is the same aggregation again over the union, and every step has map-side
partial aggregation: a key that holds a third of all rows leaves each map task as
one row.

Column policies
    last            newest value wins, also when it is NULL
    last_present    newest value that is not NULL
    last_non_empty  newest value that is neither NULL nor ''
    first           value of the oldest row, fixed from then on
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartstream.operators.ordered import HOT_ROWS, hot_groups, join_groups

POLICIES = ("last", "last_present", "last_non_empty", "first")


@dataclass(frozen=True)
class UpsertSpec:
    """How a table's rows are keyed and how each column is kept up to date."""

    key: tuple[str, ...]
    columns: dict[str, str]
    defaults: dict[str, object] = field(default_factory=dict)
    order: tuple[str, ...] = ("received_at", "webhook_id", "item")

    def __post_init__(self):
        bad = {c: p for c, p in self.columns.items() if p not in POLICIES}
        if bad:
            raise ValueError(f"unknown policies {bad}; use one of {POLICIES}")

    def of(self, policy: str) -> list[str]:
        return [c for c, p in self.columns.items() if p == policy]

    def ordered_by(self, *order: str) -> "UpsertSpec":
        """Same table, other meaning of 'newest' (say `updated_at` before arrival)."""
        return UpsertSpec(self.key, self.columns, self.defaults, order)


def _cells(spec: UpsertSpec, columns: list[str]) -> Column:
    """(order, values): compares by order first, carries the values along."""
    return F.struct(F.struct(*spec.order).alias("o"), F.struct(*columns).alias("v"))


def fold(changes: DataFrame, spec: UpsertSpec) -> DataFrame:
    """One row per key in fold form: key columns plus (order, value) cells.

    The order columns together must be unique within a key.
    """
    aggs = []
    if spec.of("last"):
        aggs.append(F.max(_cells(spec, spec.of("last"))).alias("last"))
    if spec.of("first"):
        aggs.append(F.min(_cells(spec, spec.of("first"))).alias("first"))
    for c in spec.of("last_present"):
        aggs.append(F.max(F.when(F.col(c).isNotNull(), _cells(spec, [c]))).alias(f"keep_{c}"))
    for c in spec.of("last_non_empty"):
        aggs.append(F.max(F.when(F.col(c) != "", _cells(spec, [c]))).alias(f"keep_{c}"))
    return changes.groupBy(*spec.key).agg(*aggs)


def merge(folds: list[DataFrame], spec: UpsertSpec) -> DataFrame:
    """Merge folds of any number of batches into one fold."""
    both = reduce(DataFrame.unionByName, folds)
    cells = [c for c in both.columns if c not in spec.key]
    return both.groupBy(*spec.key).agg(
        *[(F.min if c == "first" else F.max)(c).alias(c) for c in cells]
    )


def finalize(folded: DataFrame, spec: UpsertSpec, arrived: str | None = None) -> DataFrame:
    """Fold form to plain rows, defaults filled in; `arrived` adds the order of the last update."""
    out = []
    for c, policy in spec.columns.items():
        cell = {"last": "last", "first": "first"}.get(policy, f"keep_{c}")
        value = F.col(cell)["v"][c]
        if c in spec.defaults:
            value = F.coalesce(value, F.lit(spec.defaults[c]))
        out.append(value.alias(c))
    if arrived:
        out.append(F.col("last")["o"].alias(arrived))
    return folded.select(*spec.key, *out)


def upsert(changes: DataFrame, spec: UpsertSpec) -> DataFrame:
    """Current state of all changes in one pass."""
    return finalize(fold(changes, spec), spec)


def _newest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in [*keys, *order]]
    # The order is carried once: where it is equal, the other columns decide, if they have an order.
    try:
        newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
        newest.schema  # analysed here
    except AnalysisException:
        newest = df.groupBy(*keys).agg(F.max_by(F.struct(*order, *rest), F.struct(*order)).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest_by_key(df: DataFrame, keys: list[str], order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Newest row per key of an append-only table.

    Spark aggregates whole rows by sorting them, so combining before the shuffle sorts, and spills, every row twice and
    helps hot keys only. Keys are counted first, without their rows: keys of more than `hot_rows` rows combine before the
    shuffle, so that none is sorted in one task; the rows of all others are dealt out unsorted and sorted once.
    """
    if df.isStreaming:
        return _newest(df, keys, order)
    hot = hot_groups(df, keys, hot_rows)
    if hot is None:
        return _newest(df.repartition(*keys), keys, order)
    usual, crowded = (join_groups(df, F.broadcast(hot), keys, how) for how in ("left_anti", "left_semi"))
    return _newest(usual.repartition(*keys), keys, order).unionByName(_newest(crowded, keys, order))
