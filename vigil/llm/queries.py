"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vigil.llm.byte_bpe import encode_documents
from vigil.llm.exact_dedup import exact_duplicates
from vigil.llm.language import predict_documents
from vigil.llm.license_scan import scan, scan_sql
from vigil.llm.line_dedup import fuzzy_lines
from vigil.llm.merkle import manifest, manifest_sql
from vigil.llm.near_dedup import near_duplicates
from vigil.llm.packing import pack_documents
from vigil.llm.simhash import document_fingerprints, with_near_counts
from vigil.llm.token_blocks import token_file_digests
from vigil.llm.url_filter import judge_urls
from vigil.llm.warc import page_archive_digests
from vigil.llm.whitening import whiten

#: The rules that pages are judged by.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_documents(_table(spark, sf_dir, "documents"), path, keep_ids=False)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_documents(_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_archive_digests(_table(spark, sf_dir, "pages"))


def op6_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_near_counts(document_fingerprints(_table(spark, sf_dir, "documents")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_license_scan": op3_license_scan,
    "op4_language": op4_language,
    "op5_warc": op5_warc,
    "op6_token_blocks": op6_token_blocks,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_line_dedup": op9_line_dedup,
    "op10_simhash": op10_simhash,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_url_filter": op13_url_filter,
}

#: The others are beyond SQL: tests hold them against the libraries, exact round trips,
#: held-out accuracy and brute force.
ORACLES = {
    "op3_license_scan": scan_sql(),
    "op7_exact_dedup": r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM bare)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked""",
    "op11_merkle": manifest_sql(),
    "op13_url_filter": f"""
WITH rests AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests),
rules(rule, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
fitting AS (
  SELECT page_id, host, path, rule, verdict, row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC) AS place
  FROM parts LEFT JOIN rules ON ends_with('.' || host, '.' || split_part(rule, '/', 1))
    AND starts_with(path, substr(rule, strpos(rule, '/'))))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE place = 1""",
}
