"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text without its white space is cut into chunks that end at sentence marks, so that equal passages give
equal chunks wherever they stand. Chunks are deduplicated to identifiers: their 64-bit hash, and a number
that tells apart different chunks of one hash; the number comes from comparing the chunks themselves.
A document is then its ordered list of identifiers, its recipe, and documents are compared by recipe. The
text itself is moved once, for the chunk dictionary; every later step moves recipes of a few bytes a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.names import any_names
from vigil.session import materialize

#: What `[\x20\x09-\x0D]` matches.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def without_white_space(text: Column) -> Column:
    for space in WHITE_SPACE:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def chunks(text: Column, least: int, most: int) -> Column:
    """Chunks of `text`: `least` code points, and on to the next sentence mark or to `most` code points.

    Joined they give the text back; an empty text has none."""
    pattern = rf"(?s).{{1,{least}}}+[^.,;:!?。、]{{0,{most - least}}}+[.,;:!?。、]?"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _numbered_chunks(docs: DataFrame, least: int, most: int) -> DataFrame:
    """A row for each chunk, and one with a null chunk for an empty text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(text).cast("bigint").alias("n_chars"),
        without_white_space(text).alias("bare"),
    ).select(
        "doc_id", "n_chars", F.sha2("bare", 256).alias("text_sha256"),
        F.posexplode_outer(chunks(F.col("bare"), least, most)).alias("position", "chunk"),
    ).withColumn("hash", chunk_hash(F.col("chunk")))


def recipes(docs: DataFrame, least: int = 1024, most: int = 8192) -> DataFrame:
    """doc_id, n_chars, text_sha256 and the recipe of each document, as a written table."""
    rows = _numbered_chunks(docs, least, most)
    whole = rows.where("chunk is not null").select("hash", "chunk")
    # The one movement of text: each distinct chunk once, as equal chunks fall together before the shuffle.
    shared_hashes = materialize(
        whole.groupBy("hash", "chunk").agg(F.count("*").alias("uses"))
        .groupBy("hash").agg(F.count("*").alias("contents")).where("contents > 1").select("hash"), "shared-hashes")
    same_hash = Window.partitionBy("hash").orderBy("chunk")
    clashes = materialize(
        whole.join(shared_hashes, "hash", "left_semi").distinct()
        .withColumn("number", F.row_number().over(same_hash)).where("number > 1"), "chunk-clashes")
    identified = rows.join(clashes, ["hash", "chunk"], "left").withColumn(
        "identifier", F.when(F.col("position").isNotNull(), F.struct(
            "position", "hash", F.coalesce("number", F.lit(1)).alias("number"))))
    return materialize(
        identified.groupBy("doc_id", "n_chars", "text_sha256")
        .agg(F.sort_array(F.collect_set("identifier")).alias("ordered"))
        .select("doc_id", "n_chars", "text_sha256",
                F.transform("ordered", lambda c: F.struct(c["hash"].alias("hash"), c["number"].alias("number")))
                .alias("recipe")), "recipes")


def exact_duplicates(docs: DataFrame, least: int = 1024, most: int = 8192) -> DataFrame:
    """One row per document of `docs` (doc_id, text): doc_id, n_chars, text_sha256 (of the text without white
    space, in UTF-8), keep_id, group_size and kept.

    Texts are equal when identical after deleting every character of `[\\x20\\x09-\\x0D]`; null counts as
    empty, and all empty texts are equal. Of equal texts the one with the most code points stays, then the
    one with the smallest doc_id (a null doc_id last). Rows that repeat doc_id, length and bare text are one
    document. Other columns are not read. An empty table gives an empty result.
    """
    table = recipes(docs, least, most)
    order = F.struct((-F.col("n_chars")).alias("by_length"), F.col("doc_id").isNull().alias("last"), "doc_id")
    groups = materialize(
        table.groupBy("recipe").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
        .where("group_size > 1"), "equal-recipes")
    alone = F.col("group_size").isNull()
    return table.join(groups, "recipe", "left").select(
        "doc_id", "n_chars", "text_sha256",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
                  & (F.col("n_chars") == -F.col("best.by_length")))).alias("kept"),
    )


@any_names
def keep_one_of_equal(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose document stays, with all their columns; of repeated rows, one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = {"__id": F.col("doc_id").cast("bigint"), "__chars": F.length(text).cast("bigint"),
             "__sha": F.sha2(without_white_space(text), 256)}
    stay = exact_duplicates(docs).where("kept").select(
        F.col("doc_id").alias("__stay_id"), F.col("n_chars").alias("__stay_chars"),
        F.col("text_sha256").alias("__stay_sha"))
    keyed = docs.withColumns(named)
    copies = Window.partitionBy("__id", "__chars", "__sha").orderBy("text")
    return (
        keyed.join(stay, keyed["__id"].eqNullSafe(stay["__stay_id"])
                   & (keyed["__chars"] == stay["__stay_chars"]) & (keyed["__sha"] == stay["__stay_sha"]), "left_semi")
        .withColumn("__nth", F.row_number().over(copies)).where("__nth = 1").select(*docs.columns))
