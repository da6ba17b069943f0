"""Every registered query against its SQL counterpart on the smallest tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
# The corpus operators have tests of their own.
CORPUS = set(entry.CORPUS_QUERIES)
QUERIES = {name: fn for name, fn in entry.queries().items() if name not in CORPUS}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name not in CORPUS}
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(values, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in values)


def test_rows_only_queries_are_the_named_ones():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    if name not in ORACLES:
        assert df.columns
        return
    cur = duck.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(got, df.columns) == rows(cur.fetchall(), columns)


def test_entry(spark, sf):
    os.environ["ENTRY_SF_DIR"] = sf
    assert entry.entry(spark).count() > 0
