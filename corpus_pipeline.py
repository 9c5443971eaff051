"""Cleaning and packing of a corpus: stages over the documents table, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vigil.llm.exact_dedup import keep_one_of_equal
from vigil.llm.language import keep_identified
from vigil.llm.near_dedup import keep_one_of_near
from vigil.llm.packing import pack_documents
from vigil.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without letters, or like no language, go."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return keep_one_of_equal(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words link by a similarity of 0.8 or more."""
    return keep_one_of_near(docs, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into sequences of at most 1024 tokens.

    Fewer pieces are remembered than by default, as the executors still hold the memory of the stages before."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=400_000)


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", pack)]

#: Language, signatures and packing are beyond SQL; a test holds the chain against a brute-force replay.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
