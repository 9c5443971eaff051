import hashlib
import zlib

import cases
import pytest

from compare import connect, oracle_rows, rows_of
from vigil.llm import merkle
from vigil.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, lo long, `a.b` string, n int, path int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return sha("".join(map(field, row)))


def lowered(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The root, and for each node its siblings (left, right) level by level."""
    places, steps = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, at in enumerate(places):
            run = at // 8 * 8
            steps[i].append((nodes[run:at], nodes[at + 1 : run + 8]))
            places[i] = at // 8
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], steps


def plain(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(langs, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda x: x[:3])
        trees[lang] = tree([x[2] for x in langs[lang]])
    root, tops = tree([trees[lang][0] for lang in order])
    out = []
    for lang, above in zip(order, tops):
        for (_, _, own, row), steps in zip(langs[lang], trees[lang][1]):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf((*row[:4], lowered(row[4]))) if changed else own
            beside = ""
            for left, right in steps + above:
                beside += "".join(left + right)
                node = sha("".join(left) + node + "".join(right))
            out.append((row[0], own, trees[lang][0], root, sha(beside), node, node == root))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def manifest(spark, rows):
    return merkle.manifest(spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA))


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    rows = found(QUERIES["op11_merkle"](spark, SF))
    assert rows == plain([tuple(r) for r in docs.collect()])
    assert 0 < sum(not r[-1] for r in rows) < len(rows) / 2


def test_table_equals_sql(spark):
    assert rows_of(QUERIES["op11_merkle"](spark, SF)) == oracle_rows(connect(SF), ORACLES["op11_merkle"])


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [64, 1, 2], [65, 8, 9, 3, 513] + [1] * 6, [2] * 70])
def test_heights(spark, sizes):
    rows = [(i, f"s{i}", None if k == 0 else f"l{k}", i, f"Text {i}" if i % 4 else f"text {i}")
            for k, n in enumerate(sizes) for i in range(1000 * k, 1000 * k + n)]
    assert found(manifest(spark, rows)) == plain(rows)


def test_odd_rows(spark):
    rows = [(i, s, lang, n, t) for i, t, lang, s, n, *_ in cases.rows()]
    rows += [(3, "-", "é", -5, "A"), (3, "1:-", "z", 0, "A"), (None, None, None, None, None), (None, "", "", 0, ""),
             (0, "ü", "Z", 1, "ABC"), (9, "x", "", None, "Ä" * 9)] + [(12, "x", "en", 7, "Same")] * 20
    assert found(manifest(spark, rows)) == plain(rows)
    empty = manifest(spark, [])
    assert empty.count() == 0 and empty.columns == QUERIES["op11_merkle"](spark, SF).columns


def test_one_group_is_spread_over_tasks(spark):
    rows = spark.range(3000).selectExpr("'en' lang", "cast(null as bigint) doc_id", "'same' digest")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = merkle.ranked(rows, "lang", ["doc_id", "digest"])
        assert sorted(r.lo for r in out.collect()) == list(range(3000))
        parts = [r[0] for r in out.selectExpr("spark_partition_id() p").groupBy("p").count().select("count").collect()]
        assert len(parts) >= 4 and max(parts) < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
