"""Fuzzy line deduplication by MinHash, in DataFrame functions only.

A line's character shingles are the `size` characters from each of its characters on, or the whole line where
it is shorter. Its signature holds `bands` * `rows` MinHash values; lines that agree in a whole band share a bucket.
Every class of a bucket is compared with the bucket's lead first, by the exact Jaccard similarity of their
shingle sets. Where the other classes of a bucket are then still in different components, more of them lead it, in two
rounds with components joined after each; then all that are still in different components are compared.
Links are joined to components by distributed union-find, and of each component the first line stays.

Lines are told apart by their 64-bit hash, as shingles are.
"""

from __future__ import annotations

import functools
import random

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.components import components
from vigil.llm.names import any_names
from vigil.session import materialize, materialize_by


def numbered_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), line and node of every line that is not blank."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(
        F.trim(F.col("line"), F.lit(" \t\r\x0b\x0c")) != "").withColumn("node", F.xxhash64("line"))


def shingles(line: Column, size: int) -> Column:
    """The character shingles of a line, one from each character on that has `size` - 1 others behind it."""
    # The first condition keeps a match from starting inside a surrogate pair.
    return F.regexp_extract_all(
        line, F.lit(rf"(?s)(?!\p{{Cs}})(?=(.{{{size}}}|\A.{{0,{size - 1}}}\z))"), F.lit(1))


def placed(line: Column) -> Column:
    """The line's bytes with the same width for each character, so that a shingle is found by its place."""
    narrow = F.octet_length(line) == F.char_length(line)
    return F.struct(F.when(narrow, line.cast("binary")).otherwise(F.encode(line, "UTF-32")).alias("bytes"),
                    F.when(narrow, F.lit(1)).otherwise(F.lit(4)).alias("width"))


#: Shingles that start in one piece of a line; a piece is made a string once for all of them.
PIECE = 32


def piece(bytes: Column, width: Column, at: Column, size: int) -> Column:
    """The characters that the shingles from character `at` (from 0) of a placed line on need, up to `PIECE` of them."""
    length = PIECE + size - 1
    # The mark says the order of bytes; without it, one that begins the piece would be taken for it and be lost.
    wide = F.decode(F.concat(F.lit(bytearray(b"\0\0\xfe\xff")), F.substring(bytes, at * 4 + 1, F.lit(4 * length))), "UTF-32")
    return F.when(width == 1, F.substring(bytes, at + 1, F.lit(length)).cast("string")).otherwise(wide)


def last_shingle(bytes: Column, width: Column, size: int) -> Column:
    return F.greatest((F.octet_length(bytes) / width).cast("int") - size, F.lit(0))


def hashes(line: Column, size: int) -> Column:
    """The hashes of the `shingles` of a line."""
    def of(text: Column, last: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), last), lambda at: F.xxhash64(F.substring(text, at + 1, F.lit(size))))

    def whole(p: Column) -> Column:
        last = last_shingle(p["bytes"], p["width"], size)
        # Only a piece at a time is looked through for its characters.
        pieces = F.transform(F.sequence(F.lit(0), last, F.lit(PIECE)), lambda at: F.transform(
            F.array(piece(p["bytes"], p["width"], at, size)), lambda text: of(text, F.least(last - at, F.lit(PIECE - 1))))[0])
        return F.when(p["width"] == 1, of(p["bytes"], last)).otherwise(F.flatten(pieces))

    # As an array's only element the placed line is made once, not for each shingle.
    return F.transform(F.array(placed(line)), whole)[0]


def placed_hashes(lines: DataFrame, size: int, step: int) -> DataFrame:
    """node and the hashes h0, h1, ... of `step` neighbouring shingles a row; a piece's last one fills its last row."""
    def shingle_hash(at: Column) -> Column:
        # Where all characters have one byte, none is looked for.
        return F.when(F.col("narrow"), F.xxhash64(F.substring(F.col("piece").cast("binary"), at + 1, F.lit(size)))).otherwise(
            F.xxhash64(F.substring("piece", at + 1, F.lit(size))))

    pieces = (lines.select("node", placed(F.col("line")).alias("placed")).select("node", "placed.bytes", "placed.width")
              .withColumn("end", last_shingle(F.col("bytes"), F.col("width"), size))
              .select("node", "bytes", "width", "end", F.explode(F.sequence(F.lit(0), "end", F.lit(PIECE))).alias("start"))
              .select("node", F.least(F.col("end") - F.col("start"), F.lit(PIECE - 1)).alias("last"),
                      piece(F.col("bytes"), F.col("width"), F.col("start"), size).alias("piece"))
              .withColumn("narrow", F.octet_length("piece") == F.char_length("piece")))
    return (pieces.select("*", F.explode(F.sequence(F.lit(0), "last", F.lit(step))).alias("at"))
            .select("node", *[shingle_hash(F.least(F.col("at") + i, F.col("last"))).alias(f"h{i}") for i in range(step)]))


def band_keys(lines: DataFrame, size: int, bands: int, rows: int, step: int = 4) -> DataFrame:
    """(node, keys) for each distinct line: a key per band of its MinHash signature, as a written table.

    A hash is permuted by flipping random bits; of its least value 24 bits are kept. A row holds the hashes of `step`
    shingles, and the last one's again where a line has no more, so that the least of them are aggregated."""
    draw = random.Random(1)
    flips = [draw.getrandbits(64) - (1 << 63) for _ in range(bands * rows)]
    some = [f"h{i}" for i in range(step)]
    # With the sign flipped too, the order of signed numbers is that of unsigned ones.
    sign = -(1 << 63)
    least = [F.min(F.least(*[F.col(h).bitwiseXOR(F.lit(x ^ sign).cast("bigint")) for h in some])).alias(f"m{i}")
             for i, x in enumerate(flips)]
    signed = placed_hashes(lines, size, step).groupBy("node").agg(*least).select(
        "node", *[F.shiftrightunsigned(F.col(f"m{i}").bitwiseXOR(F.lit(sign).cast("bigint")), 40).alias(f"m{i}")
                  for i in range(bands * rows)])
    keys = [F.xxhash64(F.lit(b), *[f"m{b * rows + i}" for i in range(rows)]) for b in range(bands)]
    return materialize(signed.select("node", F.array(*keys).alias("keys")), "band-keys")


def jaccard_at_least(a: Column, b: Column, n: str, m: str, percent: int) -> Column:
    """Whether two sets of `n` and `m` distinct values reach the similarity; sizes are compared first."""
    n, m = F.col(n), F.col(m)
    # intersection * 100 >= union * percent, with the intersection, and so each set, written once only
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (
        F.size(F.array_intersect(a, b)) * (100 + percent) >= (n + m) * percent)


#: Words of a sketch, each of 64 bits.
WORDS = 16


def sketches(texts: DataFrame, size: int) -> DataFrame:
    """(node, n, sketch) for each line: the size of its shingle set, and a bit for each of 64 * `WORDS` remainders of
    their hashes, set where an odd number of the set has it."""
    each = texts.select("node", F.explode(F.array_distinct(hashes(F.col("line"), size))).alias("h"))
    bit, word = F.expr("shiftleft(1L, cast(h & 63 as int))"), F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(WORDS - 1))
    # Word by word, so that a shingle changes one of them only.
    by_word = each.groupBy("node", word.alias("word")).agg(F.count("*").alias("n"), F.bit_xor(bit).alias("bits"))
    words = [F.coalesce(F.max(F.when(F.col("word") == w, F.col("bits"))), F.lit(0).cast("bigint")).alias(f"s{w}")
             for w in range(WORDS)]
    return by_word.groupBy("node").agg(F.sum("n").alias("n"), *words).select(
        "node", "n", F.struct(*[f"s{w}" for w in range(WORDS)]).alias("sketch"))


def may_reach(a: str, b: str, n: str, m: str, percent: int) -> Column:
    """False only for sets that cannot reach the similarity, by their sketches and sizes: every bit in which the
    sketches differ needs a shingle that only one of the sets holds."""
    differing = sum(F.bit_count(F.col(a)[f"s{w}"].bitwiseXOR(F.col(b)[f"s{w}"])) for w in range(WORDS))
    n, m = F.col(n), F.col(m)
    # intersection * 100 >= union * percent, written by the number of shingles that one set alone holds
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (
        differing * (100 + percent) <= (n + m) * (100 - percent))


def confirmed(pairs: DataFrame, sizes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The rows of `pairs` (u, v and more) whose shingle sets reach the similarity."""
    lines = texts.join(sizes.select("node", "n"), "node")
    return pairs.join(lines.toDF("u", "u_line", "u_n"), "u").join(lines.toDF("v", "v_line", "v_n"), "v").where(
        jaccard_at_least(hashes(F.col("u_line"), size), hashes(F.col("v_line"), size), "u_n", "v_n", percent)).select(
        pairs.columns)


def star_pairs(shared: DataFrame) -> DataFrame:
    """(u, v): classes of a bucket and its lead."""
    return shared.where("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v")).distinct()


def near_enough(pairs: DataFrame, drawn: DataFrame, percent: int) -> DataFrame:
    """The rows of `pairs` (u, v) that may reach the similarity by the sketches `drawn`."""
    return (pairs.join(drawn.toDF("u", "u_n", "u_sketch"), "u").join(drawn.toDF("v", "v_n", "v_sketch"), "v")
            .where(may_reach("u_sketch", "v_sketch", "u_n", "v_n", percent)).select("u", "v"))


def mixed(placed: DataFrame) -> DataFrame:
    """Of the rows of buckets (bucket, root and more) those of buckets with several roots."""
    several = placed.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("greatest")).where(
        "least < greatest").select("bucket")
    return placed.join(several, "bucket", "left_semi")


#: Rounds of `cross_links` before the last: how many more classes of a bucket lead it in each.
ROUNDS = (4, 16)


def cross_links(
    shared: DataFrame, roots: DataFrame, drawn: DataFrame, texts: DataFrame, size: int, percent: int
) -> list[DataFrame]:
    """(u, v) tables: components of the stars that a link between two classes of one bucket joins, by their roots.

    Leads are left out, as the stars compare them with every class of their bucket. In the rounds the next few classes
    of a bucket, by their numbers, are compared as leads are, with all behind them that are in other components, and
    components are joined. So a group of near copies is mostly one component before, in the end, all other
    classes of a bucket that are still in different ones are compared with each other. No two are compared twice for a
    bucket, and no two are left out but where they are connected."""
    rows = materialize(shared.where("node <> lead").select("bucket", "node").join(roots, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root")), "placed-lines")
    rows = materialize(mixed(rows).join(drawn, "node").select("bucket", "node", "root", "n", "sketch"), "mixed-lines")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("node"))
    leads = materialize(rows.select("bucket", "node", rank.alias("rank")).where(F.col("rank") <= sum(ROUNDS)), "more-leads")
    found, before = [], 0
    for more in (*ROUNDS, None):
        if rows.isEmpty():
            break
        if more:
            chosen = leads.where((F.col("rank") > before) & (F.col("rank") <= before + more)).select("bucket", "node")
            left = rows.join(chosen, ["bucket", "node"], "left_semi")
            before += more
        else:
            left = rows.join(leads, ["bucket", "node"], "left_anti")
        # Classes before a lead have led themselves.
        pairs = materialize(
            left.toDF("bucket", "u", "u_root", "u_n", "u_sketch").join(rows.toDF("bucket", "v", "v_root", "v_n", "v_sketch"), "bucket")
            .where((F.col("u") < F.col("v")) & (F.col("u_root") != F.col("v_root"))
                   & may_reach("u_sketch", "v_sketch", "u_n", "v_n", percent))
            .select("u", "v", "u_root", "v_root").distinct(), "crossing-pairs")
        links = materialize(confirmed(pairs, drawn, texts, size, percent).select(
            F.greatest("u_root", "v_root").alias("u"), F.least("u_root", "v_root").alias("v")).distinct(), "crossing-links")
        found.append(links)
        if more:
            moved = components(links).select(F.col("node").alias("root"), F.col("root").alias("to"))
            rows = materialize(mixed(rows.join(moved, "root", "left").select(
                "bucket", "node", F.coalesce("to", "root").alias("root"), "n", "sketch")), "mixed-lines")
    return found


def joined(roots: DataFrame, links: list[DataFrame]) -> DataFrame:
    """The components `roots` (node, root), those joined that `links` between their roots connect."""
    if not links:
        return roots
    moved = materialize(components(functools.reduce(DataFrame.unionByName, links)), "moved-roots")
    to = moved.toDF("root", "to")
    return roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")).unionByName(moved)


def fuzzy_lines(docs: DataFrame, percent: int = 85, size: int = 8, bands: int = 6, rows: int = 3) -> DataFrame:
    """One row per line of `docs` (doc_id, text) that is not blank: doc_id, line_no (from 0), keep_doc_id,
    keep_line_no, group_size and kept.

    Lines are linked where 100 * intersection >= `percent` * union of their shingle sets; of all lines that
    links or equality connect, the one with the smallest doc_id (null last) and then line_no stays.
    group_size counts lines. Blank lines belong to no group and have no row; a null or empty text has no
    line. Rows that repeat a doc_id and text stay or go together. Other columns are not read. With six
    bands of three rows a pair of similarity 0.85 shares a bucket in 99.7 of 100 cases, and one of 0.9 in
    99.96.
    """
    lines = numbered_lines(docs)
    occurrences = materialize(lines.select("doc_id", "line_no", "node"), "line-occurrences")
    texts = materialize_by(lines.select("node", "line"), ["node"], "distinct-lines", distinct=True)
    keys = band_keys(texts, size, bands, rows)
    entries = keys.select("node", F.explode("keys").alias("bucket"))
    leads = materialize(
        entries.groupBy("bucket").agg(F.min("node").alias("lead"), F.count("*").alias("n"))
        .where("n > 1").select("bucket", "lead"), "line-leads")
    shared = materialize(entries.join(leads, "bucket"), "shared-lines")
    wanted = materialize(shared.select("node").distinct(), "compared-lines")
    compared = materialize_by(texts.join(wanted, "node"), ["node"], "compared-texts")
    drawn = materialize_by(sketches(compared, size), ["node"], "line-sketches")
    near = materialize(near_enough(star_pairs(shared), drawn, percent), "star-pairs")
    stars = materialize(confirmed(near, drawn, compared, size, percent), "star-links")
    roots = components(stars)
    roots = joined(roots, cross_links(shared, roots, drawn, compared, size, percent))
    grouped = materialize(occurrences.join(roots, "node", "left").select(
        "doc_id", "line_no", F.coalesce("root", "node").alias("root")), "line-groups")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line_no")
    groups = materialize(
        grouped.groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
        .where("group_size > 1").select("root", "best.doc_id", "best.line_no", "group_size")
        .toDF("root", "best_doc_id", "best_line_no", "group_size"), "repeated-lines")
    alone = F.col("group_size").isNull()
    return grouped.join(groups, "root", "left").select(
        "doc_id", F.col("line_no").cast("bigint").alias("line_no"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_doc_id")).alias("keep_doc_id"),
        F.when(alone, F.col("line_no")).otherwise(F.col("best_line_no")).cast("bigint").alias("keep_line_no"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("best_doc_id")) & (F.col("line_no") == F.col("best_line_no"))))
        .alias("kept"))


@any_names
def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, with all their columns, their text without the lines that do not stay. Blank
    lines stay; a null text stays null."""
    gone = fuzzy_lines(docs, **options).where("not kept").groupBy(F.col("doc_id").alias("__gone_id")).agg(
        F.collect_set("line_no").alias("__gone"))
    lines = F.filter(F.split("text", "\n"), lambda line, i: ~F.coalesce(
        F.array_contains("__gone", i.cast("bigint")), F.lit(False)))
    return docs.join(gone, docs["doc_id"].cast("bigint").eqNullSafe(gone["__gone_id"]), "left").select(
        *[F.array_join(lines, "\n").alias("text") if c == "text" else docs[c] for c in docs.columns])
