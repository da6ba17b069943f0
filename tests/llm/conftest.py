import duckdb
import pytest

from cartstream.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def settings(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text) pairs, in several partitions."""

    def make(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def corpus(spark, sf):
    """(doc_id, text) of the whole documents table."""
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') AS text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    return [(int(i), t) for i, t in rows]
