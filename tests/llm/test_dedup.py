import random
import re
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import exact_dedup, line_dedup, near_dedup, simhash
from vigil.llm.components import components
from vigil.llm.shingles import MinHash, shingle_set, words
from vigil.session import materialize

SF = "/root/testdata/sf0.01"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def last(doc_id):
    return (doc_id is None, doc_id or 0)


# Exact duplicates


def plain_exact(pairs):
    groups = {}
    for doc_id, text in set(pairs):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), set()).add((doc_id, len(text)))
    out = set()
    for members in groups.values():
        keep = min(members, key=lambda m: (-m[1], last(m[0])))
        out |= {(d, n, keep[0], len(members), (d, n) == keep) for d, n in members}
    return out


def exact_rows(df):
    return sorted(((r.doc_id, r.n_chars, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("sizes", [(1024, 8192), (3, 9)])
def test_exact_duplicates(spark, sizes):
    assert exact_rows(exact_dedup.exact_duplicates(cases.frame(spark), *sizes)) == sorted(
        plain_exact(cases.pairs()), key=str)
    assert exact_dedup.exact_duplicates(cases.empty(spark)).count() == 0


def test_chunks_of_one_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "chunk_hash", F.length)
    assert exact_rows(exact_dedup.exact_duplicates(cases.frame(spark), 40, 60)) == sorted(
        plain_exact(cases.pairs()), key=str)


def test_equal_passages_give_equal_chunks(spark):
    passage = ". ".join(" ".join(cases.words(i, 12)) for i in range(40)) + "."
    frame = spark.createDataFrame([(passage,), ("Another start of some length. " + passage,)], "text string")
    a, b = (set(r[0]) for r in frame.select(exact_dedup.chunks(F.col("text"), 50, 400)).collect())
    assert len(a & b) > len(a) / 2


def test_keep_one_of_equal(spark):
    docs = cases.frame(spark)
    kept = exact_dedup.keep_one_of_equal(docs)
    assert kept.columns == docs.columns
    expected = [(d, n) for d, n, _, _, k in plain_exact(cases.pairs()) if k]
    assert sorted(((r.doc_id, len(r.text or "")) for r in kept.collect()), key=str) == sorted(expected, key=str)


# Near duplicates


def plain_near(pairs, percent, size=5):
    sets = []
    for _, text in pairs:
        w = words(text)
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    groups = cases.Groups()
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                groups.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(pairs):
        root = groups.find(i)
        least[root] = min(least.get(root, (True, 0)), last(doc_id))
    found = [least[groups.find(i)] for i in range(len(pairs))]
    return [(d, len(s), None if f[0] else f[1], last(d) == f) for (d, _), s, f in zip(pairs, sets, found)]


def near_rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_the_bitmap_lets_every_key_pass(spark):
    rows = spark.range(20_000).selectExpr("if(id = 5, null, id) doc_id", "xxhash64(id) text_hash", "'t' text")
    keys = rows.where("doc_id % 50 = 0 or doc_id is null").select("doc_id", "text_hash")
    for most_bits in (1 << 27, 1 << 15):
        left = near_dedup._among(rows, keys, most_bits)
        assert left.columns == rows.columns and left.join(keys, "text_hash").count() == 401
        assert left.count() < 1000
    assert near_dedup._among(rows, keys.limit(0)).count() == 0


def test_near_duplicates(spark):
    assert near_rows(near_dedup.near_duplicates(cases.frame(spark))) == sorted(
        plain_near(cases.pairs(), 85), key=str)
    assert near_dedup.near_duplicates(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("block", [1024, 5])
def test_a_flock_of_variants_in_blocks(spark, block):
    draw = random.Random(5)
    base = " ".join(cases.words(9, 150))
    pairs = [(1000 - i, base) for i in range(3)]
    for i in range(90):
        text = base
        for _ in range(draw.randint(0, 9)):
            text = cases.edited(text, draw.randrange(150), f"w{draw.randrange(4)}")
        pairs.append((i, text))
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
    got = near_rows(near_dedup.near_duplicates(docs, block=block))
    assert got == sorted(plain_near(pairs, 85), key=str)
    assert 1 < len({r[2] for r in got}) < 90


def test_pairs_of_different_homes_are_found(spark):
    """Classes 1-2 and 3-4 share buckets' leads, 2 and 3 only a bucket led by neither home."""
    table = spark.createDataFrame([(n, 10, [0] * 10) for n in range(5)],
                                  "node bigint, n_shingles bigint, signature array<bigint>")
    shared = spark.createDataFrame([(1, 2, 0), (1, 0, 0), (2, 4, 1), (2, 1, 1), (3, 2, 2), (3, 4, 2)],
                                   "bucket bigint, node bigint, lead bigint")
    homes = shared.groupBy("node").agg(F.min("lead").alias("home"))
    found = near_dedup.cross_pairs(shared, homes, table, 10, 1, 85).groupBy("work").count().collect()
    assert [tuple(r) for r in found] == [("2-4", 2)]


def test_the_leads_of_a_flock_share_a_home(spark):
    """Classes 2, 3 and 4 meet in a bucket, and each has a bucket of its own whose lead is 0, 1 or 2."""
    shared = spark.createDataFrame([(1, 2, 0), (1, 0, 0), (2, 3, 1), (2, 1, 1), (3, 2, 2), (3, 3, 2), (3, 4, 2), (4, 7, 7), (4, 8, 7)],
                                   "bucket bigint, node bigint, lead bigint")
    homes = {r.node: r.home for r in near_dedup.nearest_homes(shared).collect()}
    assert homes == {0: 0, 1: 1, 2: 0, 3: 0, 4: 0, 7: 7, 8: 7}


def test_work_grows_as_a_flock_does(spark, monkeypatch):
    """Each class is named by one piece of work, or few, however many leads its flock has."""
    write, rows = near_dedup.materialize, []

    def seen(df, name):
        table = write(df, name)
        if name == "work":
            rows.append(table.count())
        return table

    monkeypatch.setattr(near_dedup, "materialize", seen)
    base = " ".join(cases.words(9, 150))
    for size in (60, 120):
        draw, texts = random.Random(7), set()
        while len(texts) < size:
            text = base
            for _ in range(draw.randint(2, 6)):
                text = cases.edited(text, draw.randrange(150), f"w{draw.randrange(1000)}")
            texts.add(text)
        pairs = list(enumerate(sorted(texts)))
        docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
        assert near_rows(near_dedup.near_duplicates(docs)) == sorted(plain_near(pairs, 85), key=str)
    assert rows[0] <= 90 and rows[1] <= 180


def test_the_table_against_brute_force(spark):
    pairs = [(r.doc_id, r.text or "") for r in documents(spark).collect()]
    assert near_rows(near_dedup.near_duplicates(documents(spark), 80)) == sorted(plain_near(pairs, 80), key=str)


def test_symbol_distance_and_masks(spark):
    draw = np.random.default_rng(2)
    a = draw.integers(0, 1 << 16, (40, 40), np.uint16)
    b = np.where(draw.random((40, 40)) < 0.3, draw.integers(0, 1 << 16, (40, 40), np.uint16), a)
    rows = [(x.view(np.int64).tolist(), y.view(np.int64).tolist()) for x, y in zip(a, b)]
    frame = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = [r[0] for r in frame.select(near_dedup.symbol_distance("a", "b", 10)).collect()]
    assert got == (a != b).sum(axis=1).tolist()
    keys = [frame.select(F.col(c).alias("signature"), F.monotonically_increasing_id().alias("i"))
            .select("i", near_dedup.chunk_keys(10, 1).alias("k")) for c in "ab"]
    together = {r.i for r in keys[0].join(keys[1], ["i", "k"]).collect()}
    near = {i for i, r in enumerate(frame.select(F.monotonically_increasing_id(), "a").collect()) if got[i] < 20}
    ids = [r[0] for r in frame.select(F.monotonically_increasing_id()).collect()]
    assert {ids[i] for i in near} <= together


def test_minhash_agrees_as_often_as_sets_do():
    draw = random.Random(4)
    base = cases.words(7, 3000)
    other = [w if draw.random() > 0.03 else "q" + w for w in base]
    a, b = shingle_set(" ".join(base)), shingle_set(" ".join(other))
    similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    x, y = MinHash(2000)([a, b])
    assert abs((x.view(np.uint16) == y.view(np.uint16)).mean() - similarity) < 0.04


def test_components(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(2000, 2000 + i) for i in range(50)] + [(None, 3), (7, 7)]
    groups = cases.Groups()
    for u, v in edges:
        if u is not None:
            groups.join(u, v)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {n: groups.find(n) for n in groups.above if groups.find(n) != n}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_keep_one_of_near(spark):
    docs = cases.frame(spark)
    kept = near_dedup.keep_one_of_near(docs)
    assert kept.columns == docs.columns
    expected = [d for d, _, _, k in plain_near(cases.pairs(), 80) if k]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(expected, key=str)


# Lines


def plain_lines(pairs, percent, size=8):
    rows, sets = [], {}
    for doc_id, text in pairs:
        for n, line in enumerate(text.split("\n")):
            if line.strip(" \t\r\x0b\x0c"):
                rows.append((doc_id, n, line))
                sets[line] = set(re.findall(rf"(?s)(?<!\S)(?=(\S.{{0,{size - 1}}}))", line))
    groups = cases.Groups()
    names = sorted(sets)
    holding = {}
    for name in names:
        for s in sets[name]:
            holding.setdefault(s, []).append(name)
    for name in names:
        for other in {o for s in sets[name] for o in holding[s] if o < name}:
            a, b = sets[name], sets[other]
            if 100 * len(a & b) >= percent * len(a | b):
                groups.join(name, other)
    members = {}
    for doc_id, n, line in rows:
        members.setdefault(groups.find(line), []).append((doc_id, n))
    out = []
    for doc_id, n, line in rows:
        group = members[groups.find(line)]
        keep = min(group, key=lambda m: (*last(m[0]), m[1]))
        out.append((doc_id, n, *keep, len(group), (doc_id, n) == keep))
    return sorted(out, key=str)


def line_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_fuzzy_lines(spark):
    assert line_rows(line_dedup.fuzzy_lines(cases.frame(spark), bands=16, rows=2)) == plain_lines(cases.pairs(), 85)
    assert line_dedup.fuzzy_lines(cases.empty(spark)).count() == 0


def test_chained_lines_are_one_component(spark):
    base = " ".join(cases.words(3, 60))
    texts, text = [base], base
    for i in range(25):
        text = cases.edited(text, i, f"edit{i}")
        texts.append(text)
    pairs = [(i, "\n".join([t, "unlike " + " ".join(cases.words(100 + i, 20))])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
    got = line_rows(line_dedup.fuzzy_lines(docs, bands=16, rows=2))
    assert got == plain_lines(pairs, 85)


def plain_character_lines(pairs, percent, size=8):
    """As plain_lines, but by the shingles of every character. Sets that are similar enough share one of the
    shingles that stay when the common rest that they need is taken away from either, in one order of all."""
    rows = [(d, n, line) for d, text in pairs for n, line in enumerate(text.split("\n")) if line.strip(" \t\r\x0b\x0c")]
    sets = {line: {line[i : i + size] for i in range(max(len(line) - size, 0) + 1)} for _, _, line in rows}
    groups = cases.Groups()
    often = Counter(s for shingles in sets.values() for s in shingles)
    holding = {}
    for a in sorted(sets):
        ranked = sorted(sets[a], key=lambda s: (often[s], s))
        first = ranked[: len(ranked) - -(-percent * len(ranked) // 100) + 1]
        for b in {b for s in first for b in holding.get(s, ())}:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                groups.join(a, b)
        for s in first:
            holding.setdefault(s, []).append(a)
    members = {}
    for doc_id, n, line in rows:
        members.setdefault(groups.find(line), []).append((doc_id, n))
    keep = {root: min(group, key=lambda m: (*last(m[0]), m[1])) for root, group in members.items()}
    out = [(d, n, *keep[r], len(members[r]), (d, n) == keep[r])
           for d, n, line in rows for r in [groups.find(line)]]
    return sorted(out, key=str)


def test_lines_without_spaces_are_compared_whole(spark):
    address = "https://example.org/a/long/path/to/some/page/of/this/site/index"
    chinese = "今天天气很好我们一起去公园散步然后回家吃饭再看一会儿书最后早点休息准备明天的工作和学习任务"
    lines = [address + ".html", address + ".htm", "https://b.net/22", "https://a.org/1", "- https://a.org/1",
             "- https://b.net/22", "Andththwhes.", "Andththwhwh.", chinese, "都" + chinese, chinese[:8] + "但是别的都不一样",
             "\U0001f600" * 9 + address, "\U0001f600" * 9 + address + "s", "\U0001f600\U0001f601 ab", "short", "shor", " short"]
    pairs = [(100 + i, line) for i, line in enumerate(lines)] + cases.pairs()
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
    got = line_rows(line_dedup.fuzzy_lines(docs, bands=16, rows=2))
    assert got == plain_character_lines(pairs, 85)
    kept = {r[0]: r[2] for r in got if r[1] == 0}
    assert [kept[100 + i] - 100 for i in range(11)] == [0, 0, 2, 3, 4, 5, 6, 7, 8, 8, 10]


def test_lines_of_the_table(spark):
    pairs = [(r.doc_id, r.text or "") for r in documents(spark).collect()]
    got = set(line_rows(line_dedup.fuzzy_lines(documents(spark))))
    expected = set(plain_character_lines(pairs, 85))
    assert len(got) == len(expected)
    assert len(got & expected) >= 0.995 * len(expected)  # banding may miss a pair near the threshold


def test_shingles_are_of_code_points(spark):
    text = "ab\U0001f600cd\U0001f601\n efghij"
    frame = spark.createDataFrame([(text,), ("\U0001f600b",), ("12345678",)], "line string")
    got = [r[0] for r in frame.select(line_dedup.shingles(F.col("line"), 8)).collect()]
    assert got == [[text[i : i + 8] for i in range(len(text) - 7)], ["\U0001f600b"], ["12345678"]]


def test_hashes_and_signatures_are_those_of_the_shingles(spark, monkeypatch):
    """By a line's places: one hash for each shingle in order, and the keys are the same for every step, so that
    the clamped places at the end of a line add none."""
    text = "ab\U0001f600cd\U0001f601\n efghij 今天天气 and so on, one after another"
    lines = [text, "\U0001f600b", "12345678", "123456789", "今天天气很好我们一起"]
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "node bigint, line string")
    got = frame.select("node", line_dedup.hashes(F.col("line"), 8).alias("h"),
                       F.transform(line_dedup.shingles(F.col("line"), 8), lambda s: F.xxhash64(s)).alias("s"))
    assert [(r.node, r.h) for r in got.collect()] == [(r.node, r.s) for r in got.collect()]
    keys = [sorted((r.node, r["keys"]) for r in line_dedup.band_keys(frame, 8, 6, 3, step).collect()) for step in (2, 4, 8)]
    assert len(keys[0]) == 5 and keys[0] == keys[1] == keys[2]


def test_near_copies_of_a_bucket_are_not_paired_all_with_all(spark, monkeypatch):
    """The lead is like none of them: rounds join 60 near copies by a few times 60 pairs, not by 1,770."""
    base = " ".join(cases.words(3, 60))
    lines = ["a lead that is unlike the others"] + [cases.edited(base, i, f"edit{i}") for i in range(60)] + [
        " ".join(cases.words(200 + i, 20)) for i in range(3)]
    texts = spark.createDataFrame(list(enumerate(lines)), "node bigint, line string")
    shared = texts.select(F.lit(7).cast("bigint").alias("bucket"), "node", F.lit(0).cast("bigint").alias("lead"))
    drawn = line_dedup.sketches(texts, 8)
    written = []

    def counting(df, name="step", folder=None):
        table = materialize(df, name, folder)
        written.append((name, table.count()))
        return table

    monkeypatch.setattr(line_dedup, "materialize", counting)
    found = line_dedup.cross_links(shared, spark.createDataFrame([], "node bigint, root bigint"), drawn, texts, 8, 85)
    groups = cases.Groups()
    for links in found:
        for u, v in links.collect():
            groups.join(u, v)
    assert len({groups.find(i) for i in range(1, 61)}) == 1
    assert len({groups.find(i) for i in range(64)}) == 5
    assert 59 <= sum(n for name, n in written if name == "crossing-pairs") <= 4 * 60


def test_rounds_do_not_grow_with_a_bucket(spark, monkeypatch):
    """Of 100 classes only four are near copies, none of them among those that lead the bucket first."""
    lines = ["a lead that is unlike the others"] + [" ".join(cases.words(300 + i, 12)) for i in range(100)]
    for a, b in ((40, 90), (95, 99)):
        lines[b] = cases.edited(" ".join(cases.words(a, 40)), 3, "edit")
        lines[a] = " ".join(cases.words(a, 40))
    texts = spark.createDataFrame(list(enumerate(lines)), "node bigint, line string")
    shared = texts.select(F.lit(7).cast("bigint").alias("bucket"), "node", F.lit(0).cast("bigint").alias("lead"))
    written = []

    def noting(df, name="step", folder=None):
        written.append(name)
        return materialize(df, name, folder)

    monkeypatch.setattr(line_dedup, "materialize", noting)
    found = line_dedup.cross_links(
        shared, spark.createDataFrame([], "node bigint, root bigint"), line_dedup.sketches(texts, 8), texts, 8, 85)
    assert sorted(tuple(r) for links in found for r in links.collect()) == [(90, 40), (99, 95)]
    assert written.count("crossing-pairs") <= 3


def test_a_byte_order_mark_is_a_character(spark):
    """Also where a shingle or a piece of a line begins with it."""
    lines = ["\ufeff" + "é" * 20 + "\ufeffab", "é" * line_dedup.PIECE + "\ufeffand what follows it", "\ufeffshort"]
    frame = spark.createDataFrame(list(enumerate(lines)), "node bigint, line string")
    for r in frame.select(line_dedup.hashes(F.col("line"), 8).alias("h"),
                          F.transform(line_dedup.shingles(F.col("line"), 8), lambda s: F.xxhash64(s)).alias("s")).collect():
        assert r.h == r.s
    placed = line_dedup.placed_hashes(frame, 8, 1).groupBy("node").agg(F.collect_set("h0").alias("h"))
    whole = frame.select("node", F.array_distinct(line_dedup.hashes(F.col("line"), 8)).alias("h"))
    assert {(r.node, frozenset(r.h)) for r in placed.collect()} == {(r.node, frozenset(r.h)) for r in whole.collect()}


def test_sketches_let_similar_sets_pass(spark):
    """Of all pairs of lines, none that reaches the similarity is left out, and most others are."""
    lines = sorted({line for _, text in cases.pairs() for line in text.split("\n") if line.strip()} | {
        cases.edited(" ".join(cases.words(3, n)), i, "edit") for n in (20, 60) for i in range(6)})
    texts = spark.createDataFrame(list(enumerate(lines)), "node bigint, line string")
    drawn = line_dedup.sketches(texts, 8)
    sizes = {r.node: r.n for r in drawn.collect()}
    sets = {i: {t[j : j + 8] for j in range(max(len(t) - 8, 0) + 1)} for i, t in enumerate(lines)}
    assert sizes == {i: len(s) for i, s in sets.items()}
    pairs = [(i, j) for i in sets for j in sets if i < j]
    near = {p for p in pairs if 100 * len(sets[p[0]] & sets[p[1]]) >= 85 * len(sets[p[0]] | sets[p[1]])}
    got = {tuple(r) for r in line_dedup.near_enough(
        spark.createDataFrame(pairs, "u bigint, v bigint"), drawn, 85).collect()}
    assert near and near <= got and len(got) < len(near) + len(pairs) // 10


def test_without_repeated_lines(spark):
    docs = spark.createDataFrame([(1, "One line here.\n\nTwo.", "a"), (2, "Two.\nNew words.", None), (3, None, "c")],
                                 "doc_id bigint, text string, line_no string")
    got = line_dedup.without_repeated_lines(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "One line here.\n\nTwo.", "a"), (2, "New words.", None), (3, None, "c")]


# Fingerprints


def test_document_fingerprints(spark):
    import hashlib

    pairs = sorted(set(cases.pairs()), key=lambda p: (
        p[0] is not None, p[0] or 0, hashlib.sha256(f"{'null' if p[0] is None else p[0]}:{p[1]}".encode()).hexdigest()))
    got = simhash.document_fingerprints(cases.frame(spark).repartition(4)).collect()
    by_text = {}
    expected = []
    for (doc_id, text), (_, following) in zip(pairs, pairs[1:] + pairs[:1]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    unique = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in got}
    assert sorted(unique, key=str) == sorted(expected, key=str)
    for (doc_id, text), key in zip(pairs, expected):
        by_text.setdefault(text, set()).add(unique[key].fingerprint)
        assert 0 <= unique[key].near_next <= 1 and len(unique[key].edited_fingerprint) == 16
    assert all(len(f) == 1 for f in by_text.values())
    for i, (_, text) in enumerate(pairs):
        row, following = unique[expected[i]], unique[expected[(i + 1) % len(pairs)]]
        bits = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 64
        assert row.near_next == bits(row.fingerprint, following.fingerprint)
        assert row.near_edited == bits(row.fingerprint, row.edited_fingerprint)
    assert simhash.document_fingerprints(cases.empty(spark)).count() == 0
    one = simhash.document_fingerprints(spark.createDataFrame([(5, "a b c d")], "doc_id bigint, text string")).first()
    assert one.near_next == 1.0


def test_votes_are_those_of_the_terms(spark):
    text = "one two two three Three seven"
    frame = spark.createDataFrame([(1, text)], "id int, text string")
    hashes = {r.t: r.h for r in frame.select(F.explode(simhash.terms(F.col("text"))).alias("t")).select(
        "t", F.xxhash64("t").alias("h")).collect()}
    terms = text.lower().split()
    expected = 0
    for bit in range(64):
        votes = sum(len(t) * (1 if hashes[t] >> bit & 1 else -1) for t in terms)
        expected |= (votes > 0) << bit
    got = simhash.fingerprints(frame, ["id"]).first().fingerprint
    assert got & (2**64 - 1) == expected


@pytest.mark.parametrize("radius,blocks", [(0, 1), (2, 4), (3, 6), (5, 8)])
def test_search_finds_all_within_the_radius(spark, radius, blocks):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(30)] + [0, 2**64 - 1, 1 << 63]
    values = set(base)
    for v in base:
        for _ in range(12):
            flipped = v
            for bit in draw.sample(range(64), draw.randint(0, 8)):
                flipped ^= 1 << bit
            values.add(flipped)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    queries = signed[::3]
    index = spark.createDataFrame([(v,) for v in signed + signed[:5] + [None]], "fingerprint bigint")
    got = [tuple(r) for r in simhash.search(index.where(F.col("fingerprint").isin(queries)), index, radius, blocks).collect()]
    assert len(got) == len(set(got))
    apart = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    assert set(got) == {(q, v) for q in queries for v in signed if apart(q, v) <= radius}


def test_near_counts(spark):
    docs = spark.createDataFrame([(0, "same words here"), (1, "same words here"), (50, "other"), (51, "same words here")],
                                 "doc_id bigint, text string")
    got = {r.doc_id: r.n_near for r in simhash.with_near_counts(simhash.document_fingerprints(docs)).collect()}
    assert got == {0: 2, 1: None, 50: 0, 51: None}
