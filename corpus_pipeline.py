"""A corpus pipeline: quality filter, near-duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next one's docs. All but
the last return the columns of `docs`, with text and n_chars as the stage left them. Null and empty texts, repeated rows, null ids and
extra columns are handled as the operators say; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartstream.llm import near_duplicates, packing, phrases, quality, secrets
from cartstream.llm.common import prepare, read_table
from cartstream.session import cut_lineage

NEAR_PERCENT = 80
PASSAGE_WORDS = 13
WIDTH = 2048


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars, where the table has it, as the text now is."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.5 or more; the model is fitted to these documents and the labels of the folder."""
    prepare(spark)
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(quality.score_column(model, F.col("text")) >= 0.5)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of smallest doc_id; rows of one doc_id are one document."""
    prepare(spark)
    name = "_gone"
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    gone = near_duplicates.near_duplicates(docs, percent=NEAR_PERCENT).filter("not kept").select(F.col("doc_id").alias(name))
    return docs.join(gone, docs["doc_id"].cast("long") == F.col(name), "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; a document without any other text stays, with what is left."""
    prepare(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    left = phrases.remove_repeated_words(docs, PASSAGE_WORDS, carry=others)
    columns = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("text")}
    return _measured(left.select(*[columns.get(c, F.col("carried")[c] if others else None).alias(c) for c in docs.columns]))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark."""
    prepare(spark)
    return _measured(secrets.redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    prepare(spark)
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), width=WIDTH
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("secret scans", secret_scans),
    ("packing", pack),
]

# The classifier and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), compression="zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
