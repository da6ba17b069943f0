"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

import cartstream
from cartstream.session import tune

# Rows and bytes handed to Python at once: bounds the memory of a worker whatever the length of the texts.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, small Arrow batches, and Python workers that find this library.

    On a cluster the library is installed or shipped with the job; the path only helps where it is run from its folder.
    """
    tune(spark)
    home = os.path.dirname(os.path.dirname(os.path.abspath(cartstream.__file__)))
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), home]))
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table of a folder."""
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def doc_id(docs: DataFrame):
    """doc_id as a long. A plain column where it is one: an alias would keep Spark from seeing that two exchanges are the same."""
    return F.col("doc_id") if docs.schema["doc_id"].dataType == LongType() else F.col("doc_id").cast("long").alias("doc_id")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text of a table of documents, a null text as the empty one."""
    return docs.select(doc_id(docs), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
