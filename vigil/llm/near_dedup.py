"""Near duplicates by a multi-index Hamming join of MinHash signatures, confirmed on the full shingle sets.

Signatures have `chunks` chunks of four 16-bit symbols. Where two of them differ in fewer than
`chunks` * (`errors` + 1) symbols, some chunk differs in `errors` symbols at most, by pigeonhole. So each
chunk is indexed once for every choice of `errors` symbols, with these masked out: all pairs under that
distance share a bucket. With 10 chunks and one error this holds up to 19 of 40 symbols; a pair of similarity
0.85 differs in 6 on average and exceeds 19 about once in ten million times.

Documents with equal sets are one class, and only classes are indexed. Pairs of a bucket are never listed
where classes flock together: each class gets a home, the least lead of its buckets or of those that it shares a
bucket with, and the classes of one home are compared in blocks of bounded size. Only pairs of different homes are joined
one by one, under the signature distance. All comparisons use the full sets, recomputed from the texts of
the classes that share a bucket, and give a spanning forest of the links, never all links of a block.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.components import components
from vigil.llm.memory import begin
from vigil.llm.names import any_names
from vigil.llm.pieces import in_groups
from vigil.llm.shingles import MinHash, shingle_set
from vigil.session import materialize

SYMBOLS_A_CHUNK = 4


def signatures(docs: DataFrame, shingle: int, chunks: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (of the shingle set; null without words), signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("shingles")
        minhash = MinHash(chunks * SYMBOLS_A_CHUNK)
        for batch in batches:
            for first, group in in_groups(batch.column(2)):
                sets = [shingle_set(t, shingle) for t in group]
                rows = iter(minhash([s for s in sets if len(s)]).tolist())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(first, len(group)),
                    "text_hash": batch.column(1).slice(first, len(group)),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_id": pa.array([_set_id(s) for s in sets], pa.binary()),
                    "signature": pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64()))})

    return _rows(docs).mapInArrow(
        run, "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary, signature array<bigint>")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")


def _set_id(shingles: np.ndarray) -> bytes | None:
    return hashlib.sha256(shingles.tobytes()).digest()[:16] if len(shingles) else None


def classes(signed: DataFrame) -> DataFrame:
    """One row per distinct shingle set, as a written table: node (a number of its own), set_id, n_shingles,
    signature, least doc_id, and the row (doc_id, text_hash) to take its text from."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash"))
    return materialize(
        signed.where("set_id is not null").groupBy("set_id").agg(
            F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), best.alias("best"))
        .select("set_id", "n_shingles", "signature", "best.doc_id", "best.text_hash")
        .withColumn("node", F.monotonically_increasing_id()), "classes")


def chunk_keys(chunks: int, errors: int) -> Column:
    """The buckets of a signature: each chunk with each choice of `errors` symbols masked out."""
    keys = []
    for chunk in range(chunks):
        for wrong in itertools.combinations(range(SYMBOLS_A_CHUNK), errors):
            mask = sum(0xFFFF << 16 * i for i in range(SYMBOLS_A_CHUNK) if i not in wrong)
            mask -= 1 << 64 if mask >> 63 else 0
            masked = F.col("signature")[chunk].bitwiseAND(F.lit(mask).cast("bigint"))
            keys.append(F.xxhash64(F.lit(len(keys)), masked))
    return F.explode(F.array(*keys))


def symbol_distance(a: str, b: str, chunks: int) -> Column:
    """In how many symbols the two signatures differ."""
    total = F.lit(0)
    for chunk in range(chunks):
        x = F.col(a)[chunk].bitwiseXOR(F.col(b)[chunk])
        for shift in (8, 4, 2, 1):  # the lowest bit of each symbol gathers all its bits
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x0001000100010001)))
    return total


def shared_buckets(table: DataFrame, chunks: int, errors: int) -> DataFrame:
    """bucket, node, lead (least node of the bucket) for buckets of two classes or more, as a written table."""
    entries = table.select("node", chunk_keys(chunks, errors).alias("bucket"))
    leads = materialize(
        entries.groupBy("bucket").agg(F.min("node").alias("lead"), F.count("*").alias("n"))
        .where("n > 1").select("bucket", "lead"), "bucket-leads")
    return materialize(entries.join(leads, "bucket"), "shared-buckets")


def nearest_homes(shared: DataFrame) -> DataFrame:
    """(node, home), as a written table: the least lead of a class's buckets and of its bucket mates' buckets.

    By the first step alone a flock has as many homes as it has small leads, and its pairs across them grow with
    its square; the second step joins these."""
    own = materialize(shared.groupBy("node").agg(F.min("lead").alias("home")), "own-leads")
    reached = materialize(
        shared.join(own, "node").groupBy("bucket").agg(F.min("home").alias("home")), "bucket-homes")
    return materialize(
        shared.select("bucket", "node").join(reached, "bucket").groupBy("node").agg(F.min("home").alias("home")), "homes")


def home_blocks(homes: DataFrame, table: DataFrame, block: int, block_shingles: int) -> DataFrame:
    """(work, node): for each home every pair of its blocks, with the classes of both.

    A home has as many blocks as keep each near `block` classes and `block_shingles` shingles."""
    sized = homes.join(table.select("node", "n_shingles"), "node")
    blocks = materialize(
        sized.groupBy("home").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).where("n > 1")
        .select("home", F.ceil(F.greatest(F.col("n") / block, F.col("shingles") / block_shingles)).alias("blocks")),
        "home-blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    return homes.join(blocks, "home").select("node", "home", "blocks", own.alias("own")).select(
        "node", "home", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        F.concat_ws(":", "home", F.least("own", "other"), F.greatest("own", "other")).alias("work"), "node")


def cross_pairs(shared: DataFrame, homes: DataFrame, table: DataFrame, chunks: int, errors: int, percent: int) -> DataFrame:
    """(work, node): two rows for each pair of classes of one bucket but different homes whose signatures are
    within the distance and whose sizes allow the similarity."""
    placed = materialize(shared.select("bucket", "node").join(homes, "node"), "placed")
    # The home that most classes of a bucket share; a bucket of one home has no such pair.
    by_size = F.struct("n", "home")
    major = materialize(
        placed.groupBy("bucket", "home").agg(F.count("*").alias("n"))
        .groupBy("bucket").agg(F.max(by_size)["home"].alias("major"), F.count("*").alias("homes"))
        .where("homes > 1").select("bucket", "major"), "mixed-buckets")
    mixed = materialize(placed.join(major, "bucket").join(
        table.select("node", "n_shingles", "signature"), "node"), "mixed-entries")
    left = mixed.where("home <> major").select(
        "bucket", F.col("node").alias("a"), F.col("home").alias("a_home"), F.col("n_shingles").alias("a_n"),
        F.col("signature").alias("a_signature"))
    right = mixed.select(
        "bucket", "major", F.col("node").alias("b"), F.col("home").alias("b_home"), F.col("n_shingles").alias("b_n"),
        F.col("signature").alias("b_signature"))
    once = (F.col("b_home") == F.col("major")) | (F.col("a") < F.col("b"))
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    near = symbol_distance("a_signature", "b_signature", chunks) < chunks * (errors + 1)
    joined = left.join(right, "bucket").where(
        (F.col("a_home") != F.col("b_home")) & once & sizes & near).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return joined.select(F.concat_ws("-", "a", "b").alias("work"), F.explode(F.array("a", "b")).alias("node"))


def linked_forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links 100 * intersection >= percent * union between the sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    values, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.zeros((len(sets), len(sets)), np.float32)
    number = np.cumsum(uses > 1) - 1  # shingles of one set alone meet nothing
    held = uses[column] > 1
    owners, column = owners[held], number[column[held]]
    order = np.argsort(column, kind="stable")
    owners, column = owners[order], column[order]
    columns = int(column[-1]) + 1 if len(column) else 0
    width = max(1, min(columns, (1 << 22) // len(sets)))
    for start in range(0, columns, width):
        a, b = np.searchsorted(column, [start, start + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owners[a:b], column[a:b] - start] = 1
        common += has @ has.T
    linked = np.empty(common.shape, bool)
    for start in range(0, len(sets), 256):  # a strip at a time, as wide numbers take eight times the room
        both = common[start : start + 256].astype(np.int64)
        linked[start : start + 256] = 100 * both >= percent * (sizes[start : start + 256, None] + sizes - both)
    edges, waiting = [], np.ones(len(sets), bool)
    for root in range(len(sets)):
        if waiting[root]:
            waiting[root] = False
            reached = [root]
            while reached:
                at = reached.pop()
                for found in np.flatnonzero(linked[at] & waiting).tolist():
                    waiting[found] = False
                    edges.append((at, found))
                    reached.append(found)
    return edges


_BITMAP = 32_768  # fixed value: the bits that bitmap_construct_agg puts into one bitmap


def _among(rows: DataFrame, keys: DataFrame, most_bits: int = 1 << 27) -> DataFrame:
    """`rows` without most of those whose (doc_id, text_hash) is not in `keys`, before anything is shuffled.

    The keys set bits of a bitmap that goes to all tasks: 64 bits for each key, and 16 MB at the most. Beyond two
    million keys it lets more rows pass; none of the keys' own is ever lost."""
    bits = 1 << min(most_bits.bit_length() - 1, max(15, (64 * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(bits))
    bitmaps = keys.select(place.alias("at")).groupBy(F.floor(F.col("at") / _BITMAP).alias("part")).agg(
        F.bitmap_construct_agg(F.col("at") % _BITMAP).alias("bitmap"))
    within = (F.col("at") % _BITMAP).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.floor(within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), within % 8)) % 2
    marked = rows.withColumn("at", place).withColumn("part", F.floor(F.col("at") / _BITMAP))
    return marked.join(F.broadcast(bitmaps), "part").where(bit != 0).select(*rows.columns)


def links(docs: DataFrame, table: DataFrame, work: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(u, v): links among the classes of each piece of work, enough to connect whatever is linked.

    The texts of the classes at work are shuffled once, each to all the work that names it; then the sets go there."""
    wanted = materialize(work, "work")
    sources = materialize(wanted.select("node").distinct().join(table, "node").select(
        "node", "set_id", "doc_id", "text_hash"), "sources")
    claims = materialize(wanted.join(sources, "node"), "claims")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("shingles")
        text, found, own = None, b"", None
        for batch in batches:
            for first, group in in_groups(batch.column(3)):
                wanted_ids = batch.column(2).slice(first, len(group)).to_pylist()
                keep, sets = [], []
                for i, (row_text, wanted_id) in enumerate(zip(group, wanted_ids)):
                    if row_text != text:  # the rows of a text for different work follow each other
                        of_text = shingle_set(row_text, shingle)
                        text, found, own = row_text, of_text.tobytes(), _set_id(of_text)
                    if own == wanted_id:
                        keep.append(i)
                        sets.append(found)
                kept = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "work": batch.column(0).slice(first, len(group)).take(kept),
                    "node": batch.column(1).slice(first, len(group)).take(kept),
                    "shingles": pa.array(sets, pa.binary())})

    rows = _among(_rows(docs), sources).alias("d")
    c = claims.alias("c")
    sets = rows.join(c, F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_hash") == F.col("c.text_hash"))
                     ).select("c.work", "c.node", "c.set_id", "d.text").mapInArrow(
        make, "work string, node bigint, shingles binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("comparing")
        held: dict[int, np.ndarray] = {}
        current = None

        def edges() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                nodes = list(held)
                found = linked_forest(list(held.values()), percent)
                yield pa.RecordBatch.from_pydict({
                    "u": pa.array([nodes[a] for a, _ in found], pa.int64()),
                    "v": pa.array([nodes[b] for _, b in found], pa.int64())})

        for batch in batches:
            for name, node, shingles in zip(*(batch.column(i) for i in range(3))):
                if (name := name.as_py()) != current:
                    yield from edges()
                    current, held = name, {}
                held[node.as_py()] = np.frombuffer(shingles.as_py(), np.uint64)  # a repeated row counts once
        yield from edges()

    return sets.repartition("work").sortWithinPartitions("work").mapInArrow(compare, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, percent: int = 85, shingle: int = 5, chunks: int = 10, errors: int = 1,
    block: int = 1024, block_shingles: int = 400_000,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, text_hash, n_shingles, component_id, kept.

    Documents are linked where 100 * intersection >= `percent` * union of their sets of word shingles;
    component_id is the smallest doc_id that links reach, itself included, and kept says whether it is the
    document's own. A null or empty text, or one of white space alone, has no shingle and is linked with
    nothing. A null doc_id is never the smallest where there is another. Repeated rows are linked like any
    copies. Other columns are not read. An empty table gives an empty result.
    """
    signed = materialize(signatures(docs, shingle, chunks), "signatures")
    table = classes(signed)
    shared = shared_buckets(table, chunks, errors)
    homes = nearest_homes(shared)
    work = home_blocks(homes, table, block, block_shingles).unionByName(
        cross_pairs(shared, homes, table, chunks, errors, percent))
    roots = components(links(docs, table, work, shingle, percent))
    rooted = table.join(roots, "node", "left").select(
        "set_id", "doc_id", F.coalesce("root", "node").alias("root"))
    least = materialize(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
                        .where("n > 1").select("root", "component_id"), "component-ids")
    known = materialize(rooted.join(least, "root", "left").select(
        "set_id", F.coalesce("component_id", "doc_id").alias("component_id")), "class-components")
    found = signed.join(known, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


@any_names
def keep_one_of_near(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: of linked documents that with the smallest
    doc_id, and every document without words. Of repeated rows all copies stay or go."""
    stay = near_duplicates(docs, percent).where("kept").select(
        F.col("doc_id").alias("__stay_id"), F.col("text_hash").alias("__stay_hash")).distinct()
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("bigint"),
                              "__hash": F.xxhash64(F.coalesce("text", F.lit("")))})
    return keyed.join(stay, keyed["__id"].eqNullSafe(stay["__stay_id"])
                      & (keyed["__hash"] == stay["__stay_hash"]), "left_semi").select(*docs.columns)
