"""SimHash fingerprints of documents and search by Hamming distance, in DataFrame functions only.

Every term of a text hashes to 64 bits and votes with its length as weight: for a bit that it sets, against
one that it does not. A fingerprint bit is set where more than half of the weight is for it. Two votes are
counted in each 64-bit sum, in lanes of 32 bits; a text has fewer bytes than a lane can count.

The search splits fingerprints into blocks. Fingerprints that differ in at most `radius` bits agree in all
but `radius` blocks, so a table for each choice of the blocks that agree finds all of them by equality.
"""

from __future__ import annotations

import functools
import itertools
import operator

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.session import materialize

BITS = 64
_LANES = BITS // 2
_LOW = 0x100000001
_HALF = 0xFFFFFFFF


def terms(text: Column) -> Column:
    """Lower-cased runs of other than white space."""
    return F.split(F.lower(text), "[ \t\n\x0b\x0c\r]+")


def _votes() -> list[Column]:
    term_hash, weight = F.xxhash64("term"), F.length("term").cast("bigint")
    return [F.sum(F.shiftrightunsigned(term_hash, k).bitwiseAND(F.lit(_LOW)) * weight).alias(f"votes{k}")
            for k in range(_LANES)] + [F.sum(weight).alias("weight")]


def _fingerprint() -> Column:
    bits = []
    for k in range(_LANES):
        votes = F.col(f"votes{k}")
        for bit, lane in ((k, votes.bitwiseAND(F.lit(_HALF))), (k + _LANES, F.shiftrightunsigned(votes, 32))):
            # Written as a signed number, as all bits of a bigint are used.
            value = (1 << bit) - (1 << BITS if bit == BITS - 1 else 0)
            bits.append(F.when(lane * 2 > F.col("weight"), F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return functools.reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """`keys` and the 64-bit `fingerprint` of each text; null and empty texts and those of white space
    alone have 0. Rows of equal keys are counted together, which for equal texts changes nothing."""
    return (texts.select(*keys, F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("term"))
            .groupBy(*keys).agg(*_votes()).select(*keys, _fingerprint().alias("fingerprint")))


def as_hex(fingerprint: str) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")


def likeness(a: str, b: str) -> Column:
    return 1.0 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / F.lit(float(BITS))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and `key`, which tells rows apart by both."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.sha2(
        F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), text), 256).alias("key"))


def in_order(docs: DataFrame) -> DataFrame:
    """key, doc_id, n_chars and next_key of the rows of `identified`, as a written table.

    The next document is that with the next doc_id, ties by key, a null doc_id before all others; after the
    last comes the first. Only keys are sorted: rows are dealt into ranges, each range is ordered by itself,
    and the ranges' first rows link one range to the next.
    """
    rows = docs.select("doc_id", "key", F.length("text").cast("bigint").alias("n_chars")).groupBy(
        "doc_id", "key").agg(F.first("n_chars").alias("n_chars"))
    ranges = materialize(
        rows.repartitionByRange("doc_id", "key").withColumn("part", F.spark_partition_id()), "doc-order")
    firsts = ranges.groupBy("part").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    along = Window.orderBy("part")
    every = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    links = firsts.select("part", F.coalesce(
        F.lead("first").over(along), F.first("first").over(every))["key"].alias("next_part_key"))
    within = Window.partitionBy("part").orderBy("doc_id", "key")
    ordered = ranges.withColumn("next_in_part", F.lead("key").over(within)).join(links, "part")
    return materialize(ordered.select(
        "key", "doc_id", "n_chars", F.coalesce("next_in_part", "next_part_key").alias("next_key")), "doc-links")


def with_edits(docs: DataFrame, order: DataFrame) -> DataFrame:
    """key, text and `edited` of the rows of `identified`: the last quarter of the code points, rounded
    down, replaced by the first as many, or all, of the next document.

    Every text is shuffled once by its key; what goes on to the document before it is the few first
    code points that this one needs."""
    wanted = order.select(F.col("next_key").alias("key"), F.col("key").alias("for_key"),
                          F.floor(F.col("n_chars") / 4).alias("quarter"))
    texts = docs.select("key", "text")
    heads = (texts.join(wanted, "key").select(F.col("for_key").alias("key"),
                                              F.expr("substring(text, 1, quarter)").alias("head"))
             .groupBy("key").agg(F.first("head").alias("head")))
    n = F.length("text")
    return texts.join(heads, "key").select(
        "key", "text", F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), "head").alias("edited"))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint (16 hex digits), near_edited, near_next (share of equal bits, 0 to 1).

    Null counts as empty; the edited text and the next document are those of `with_edits` and `in_order`.
    Rows that repeat doc_id and text are one document; one document alone is its own next. Equal texts have
    equal fingerprints. Other columns are not read. An empty table gives an empty result.
    """
    rows = identified(docs)
    order = in_order(rows)
    both = with_edits(rows, order).select("key", F.sha2("edited", 256).alias("edited_sha256"), F.posexplode(
        F.array("text", "edited")).alias("version", "text"))
    prints = fingerprints(both, ["key", "edited_sha256", "version"])
    own = F.col("version") == 0
    table = materialize(
        prints.groupBy("key", "edited_sha256").agg(
            F.max(F.when(own, F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(~own, F.col("fingerprint"))).alias("edited_fingerprint"))
        .join(order, "key"), "fingerprints")
    following = table.select(F.col("key").alias("next_key"), F.col("fingerprint").alias("next_fingerprint"))
    return table.join(following, "next_key").select(
        "doc_id", "n_chars", "edited_sha256", as_hex("fingerprint").alias("fingerprint"),
        as_hex("edited_fingerprint").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"))


def block_masks(radius: int, blocks: int) -> list[int]:
    """A mask for each choice of `blocks` - `radius` of the blocks, as signed 64-bit numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [functools.reduce(operator.or_, chosen) for chosen in itertools.combinations(parts, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def search(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """Pairs (query, found) of different or equal 64-bit numbers that differ in at most `radius` bits.

    `queries` and `index` have one column `fingerprint`; repeated and null values are left out first. A
    pair that agrees in several tables is made by the first of them only.
    """
    if not 0 <= radius < blocks:
        raise ValueError("more blocks than differing bits are needed")
    masks = block_masks(radius, blocks)
    tables = F.posexplode(F.array(*[F.lit(m).cast("bigint") for m in masks]))

    def dealt(df: DataFrame, name: str) -> DataFrame:
        distinct = df.where("fingerprint is not null").select("fingerprint").distinct()
        return distinct.select(F.col("fingerprint").alias(name), tables.alias("block_table", "mask")).select(
            name, "block_table", F.col(name).bitwiseAND(F.col("mask")).alias("block_key"))

    apart = F.col("query").bitwiseXOR(F.col("found"))
    first_table = F.coalesce(*[
        F.when(apart.bitwiseAND(F.lit(m).cast("bigint")) == 0, F.lit(i)) for i, m in enumerate(masks)])
    return (dealt(queries, "query").join(dealt(index, "found"), ["block_table", "block_key"])
            .where((F.bit_count(apart) <= radius) & (first_table == F.col("block_table")))
            .select("query", "found"))


def with_near_counts(prints: DataFrame, every: int = 50, radius: int = 3, blocks: int = 6) -> DataFrame:
    """`prints` of `document_fingerprints` with n_near: for each document whose doc_id is divisible by
    `every`, how many other documents have a fingerprint within `radius` bits of its own; null for others."""
    table = materialize(prints, "document-fingerprints")
    number = F.conv("fingerprint", 16, -10).cast("bigint")
    classes = materialize(table.groupBy("fingerprint").agg(
        F.count("*").alias("members"), F.max(F.coalesce(F.col("doc_id") % every == 0, F.lit(False))).alias("asked"))
        .withColumn("fingerprint", number), "fingerprint-classes")
    pairs = search(classes.where("asked").select("fingerprint"), classes.select("fingerprint"), radius, blocks)
    counts = materialize(
        pairs.join(classes, F.col("found") == F.col("fingerprint")).groupBy("query")
        .agg((F.sum("members") - 1).alias("n_near"))
        .select(as_hex("query").alias("fingerprint"), "n_near"), "near-counts")
    return table.join(counts, "fingerprint", "left").select(
        *table.columns, F.when(F.col("doc_id") % every == 0, F.col("n_near")).alias("n_near"))
