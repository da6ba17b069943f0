"""The registered queries of the corpus operators, one per operator, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartstream.llm import (
    embeddings, fill_middle, fingerprints, html_text, importance, near_duplicates, packing, phrases, quality, secrets, sentencepiece,
    suffix_array, url_filters,
)
from cartstream.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return sentencepiece.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)


@query
def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, folder, "documents"), percent=85)


@query
def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(read_table(spark, folder, "documents"))


@query
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=False
    )


@query
def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(read_table(spark, folder, "embeddings"), threshold=0.98)


@query
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read_table(spark, folder, "documents"))


URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


@query
def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.filter_urls(read_table(spark, folder, "pages"), rules)


ORACLES["op10_url_filters"] = """
WITH rules(rule_host, rule_path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n
  FROM rest)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM (
  SELECT p.page_id, p.host, p.path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY p.n ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS k
  FROM parts p LEFT JOIN rules
    ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path))
WHERE k = 1
"""


@query
def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_array.remove_repeated_bytes(read_table(spark, folder, "documents"), width=50, keep=False)


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.remove_repeated_words(read_table(spark, folder, "documents"), width=13).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@query
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query
def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read_table(spark, folder, "pages"))


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.fill_in_middle(read_table(spark, folder, "documents"), digests=True)


ORACLES["op12_fill_in_middle"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(units[1:least(c1, c2)], '') AS p, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(units[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


ORACLES["op13_importance_resampling"] = r"""
WITH steps AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
  FROM range(256) t(i)),
crc_table AS (SELECT list(v ORDER BY i) AS crc FROM steps),
worded AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT 'b', 0, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
counted AS (SELECT side, id, word, count(*) AS c FROM (SELECT side, id, unnest(words) AS word FROM worded) GROUP BY ALL),
bytes AS (
  SELECT word, list_transform(range(1, length(hex(encode(word))) + 1, 2),
         lambda k: CAST('0x' || substr(hex(encode(word)), k, 2) AS BIGINT)) AS b
  FROM (SELECT DISTINCT word FROM counted)),
buckets AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, crc[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc_table),
sides AS (SELECT bucket, sum(c) FILTER (side = 'd') AS s, sum(c) FILTER (side = 'b') AS t FROM counted JOIN buckets USING (word) GROUP BY bucket),
totals AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS all_s, CAST(coalesce(sum(t), 0) AS DOUBLE) AS all_t FROM sides),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain
  FROM sides, totals),
weighed AS (
  SELECT id, CAST(sum(c) AS BIGINT) AS n, CAST(sum(c * gain) AS BIGINT) AS weight
  FROM counted JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || CAST(doc_id AS VARCHAR))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weighed ON id = doc_id),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS every FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= every * 10 // 100 THEN k END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""
