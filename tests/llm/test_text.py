import base64
import hashlib
import random
import re
from collections import Counter

import cases
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import language, license_scan, warc
from vigil.llm.license_templates import TEMPLATES

SF = "/root/testdata/sf0.01"


# Languages


def plain_grams(text, longest=3):
    symbols = [c if c.isalpha() else "\1" for c in "\1" + text.lower() + "\1"]
    joined = re.sub("\1+", "\1", "".join(symbols))
    found = Counter(c for c in joined if c != "\1")
    for n in range(2, longest + 1):
        found.update(joined[i : i + n] for i in range(len(joined) - n + 1) if "\1" not in joined[i + 1 : i + n - 1])
    return found


def number(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


@pytest.mark.parametrize("stretch", [1 << 21, 7, 3])
@pytest.mark.parametrize("text", ["", "...", "a", "Ab, ab abc!", "日本語 テスト été ÉTÉ 12a", "x y z " * 30])
def test_grams(monkeypatch, stretch, text):
    monkeypatch.setattr(language, "STRETCH", stretch)
    grams, counts = language.count_grams(text)
    assert dict(zip(grams.tolist(), counts.tolist())) == {number(g): n for g, n in plain_grams(text).items()}


def test_profiles_and_distance_against_plain_lists(spark):
    docs = spark.createDataFrame([("the cat and the hat", "en"), ("the end", "en"), ("le chat et la fin", "fr"),
                                  (None, "fr"), ("lost", None)], "text string, lang string")
    model = language.fit(docs, size=12)
    lists = {}
    for lang, texts in {"en": ["the cat and the hat", "the end"], "fr": ["le chat et la fin"]}.items():
        total = sum((plain_grams(t) for t in texts), Counter())
        lists[lang] = sorted(total, key=lambda g: (-total[g], number(g)))[:12]
    text = "the chat"
    own = plain_grams(text)
    ranked = sorted(own, key=lambda g: (-own[g], number(g)))[:12]
    distance = {lang: sum(abs(i - held.index(g)) if g in held else 12 for i, g in enumerate(ranked))
                for lang, held in lists.items()}
    best = min(distance, key=lambda lang: (distance[lang], lang))
    assert model.predict(text) == (best, 1 - distance[best] / (12 * len(ranked)))
    assert model.predict(None) == model.predict("12 ...") == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.predict_documents(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count() > 0
    assert found.where("score < 0 or score > 1").count() == 0


def test_predictions_on_odd_rows(spark):
    docs = cases.frame(spark)
    got = language.predict_documents(docs).collect()
    assert len(got) == len(cases.rows())
    for row, (doc_id, text) in zip(got, cases.pairs()):
        assert row.doc_id == doc_id
        assert (row.lang_pred == "und") == (not re.search(r"[^\W\d_]", text))
    assert language.predict_documents(cases.empty(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predict_documents(unlabelled).collect()} == {"und"}
    kept = language.keep_identified(docs.withColumn("lang_pred", F.lit(1)))
    assert kept.columns == [*docs.columns, "lang_pred"]
    worded = [d for d, t in cases.pairs() if re.search(r"[^\W\d_]", t) and d != 15]  # 15 is like no language
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(worded, key=str)


# Archives


PAGES = [(3, "http://a/WARC/1.1", "<p>" + "WARC/1.1\r\n" * 400 + "</p>"), (1, None, "<p>é 日本</p>" * 3000), (2, "u\r\nx: y", ""),
         (4, "u", None), (5, "u", "<p>é 日本</p>" * 3000), (6, "u", "WARC/1.1"), (7, "u", "x\r\n\r\nWARC/1.1\r\nWARC/1.1"),
         (None, "u", "nobody's page"), (8, "u", "nobody's page"), (8, "u", "nobody's page")]
PAGE_SCHEMA = "page_id bigint, url string, html string, digest string, segment int, block binary"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, b"b") for r in rows], PAGE_SCHEMA)


def plain_pages(rows, least):
    payloads = {(i, (html or "").encode()) for i, _, html in rows}
    out = set()
    for page_id, payload in payloads:
        same = [i for i, p in payloads if p == payload and i is not None]
        first = min(same, default=None)
        revisit = len(payload) >= least and page_id != first
        out.add((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                 "revisit" if revisit else "response", first if revisit else None, True))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back(spark, least):
    got = warc.page_archive_digests(pages(spark, PAGES), least).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_pages(PAGES, least)
    assert warc.page_archive_digests(pages(spark, [])).count() == 0


def test_pages_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in table.collect()]
    got = warc.page_archive_digests(table).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_pages(rows, 0)


def test_files_are_archives(spark, tmp_path):
    folder = str(tmp_path / "warc")
    warc.write_archives(pages(spark, PAGES).coalesce(1), folder, segment_bytes=900, chunk_bytes=100)
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")))
    at, kinds = 0, Counter()
    while at < len(data):
        assert data[at:].startswith(warc.VERSION)
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        assert rest[length:].startswith(b"\r\n\r\n")
        kinds[re.search(rb"WARC-Type: (\w+)", head)[1]] += 1
        at += len(head) + length + 8
    assert kinds[b"continuation"] > 50 and kinds[b"response"] + kinds[b"revisit"] == len(PAGES)
    records = warc.read_records(spark, folder)
    found = warc.payloads(warc.reassembled(records)).where("record_type = 'response'")
    assert found.where("not intact").count() == 0
    # A lost segment, or one too many that says otherwise, is seen.
    lost = warc.payloads(warc.reassembled(records.where("not (segment <=> 2)")))
    assert lost.where("not intact").count() == found.join(
        records.where("segment = 2").select(F.col("origin").alias("record_id")).distinct(), "record_id").count() > 0
    twice = warc.payloads(warc.reassembled(records.unionByName(records.where("segment = 2"))))
    assert twice.where("record_type = 'response' and not intact").count() == 0


def test_chunk_framing():
    draw = random.Random(8)
    for _ in range(200):
        body = b"".join(draw.choice([b"WARC/1.1\r\n", b"WARC/", b"1.1", b"\r\n", b"x", b"0\r\n\r\n"]) for _ in range(draw.randrange(40)))
        framed = warc.chunked(body, draw.randint(1, 30))
        assert warc.unchunked(framed) == body
        assert b"WARC/1.1" not in framed
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


# Licences


def plain_scan(pairs, threshold=0.8):
    bag = lambda t: (lambda w: {a + " " + b for a, b in zip(w, w[1:])})(re.findall(r"[^\W_]+", t.lower()))
    held = [(name, bag(t)) for name, t in TEMPLATES]
    out = []
    for doc_id, text in pairs:
        blocks = re.split(r"\n[ \t\r]*\n", text)
        units = [("line", i, u) for i, u in enumerate(text.split("\n"))]
        units += [("block", i, u) for i, u in enumerate(blocks) if "\n" in u]
        for unit, n, body in units:
            b = bag(body)
            dice = [2 * len(b & t) / (len(b) + len(t)) if b else 0 for _, t in held]
            best = max(range(len(held)), key=lambda i: (dice[i], i))
            if dice[best] >= threshold:
                out.append((doc_id, unit, n, held[best][0], best, dice[best], len(b)))
    return sorted(out, key=str)


def test_license_scan(spark):
    mit = TEMPLATES[12][1]
    changed = mit.replace("free of charge", "without any charge").replace("person", "body")
    pairs = [(1, mit), (2, "Intro.\n\n" + mit + "\n \nAfter it."), (3, changed), (4, mit.replace("\n", " ") * 3),
             (5, "licensed under cc by 4.0!\nLicensed under CC-BY-NC 4.0"), (6, "Released under the MIT License"),
             (7, "License."), *cases.pairs()]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in pairs] + [(9, None, 2, "y")],
                                 "doc_id bigint, text string, dice int, unit string")
    got = sorted((tuple(r) for r in license_scan.scan(docs).collect()), key=str)
    assert got == plain_scan(pairs)
    assert {"MIT", "CC-BY-4.0", "CC-BY-NC-4.0"} <= {r[3] for r in got}
    assert license_scan.scan(cases.empty(spark)).count() == 0


MIT_REST = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_whole_licences_are_found(spark):
    mit = "Copyright (c) 2024 Jane Doe\n" + TEMPLATES[12][1] + "\n" + MIT_REST
    comment = "/*\n" + "\n".join(" * " + line for line in mit.split("\n")) + "\n */"
    held = TEMPLATES[15:]
    pairs = [(0, comment)] + [(i + 1, "Jane Doe, 2024\n" + t) for i, (_, t) in enumerate(held)]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
    got = license_scan.scan(docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_scan(pairs)
    names = {r.doc_id: r.license_id for r in got if r.unit == "block"}
    assert names == {0: "MIT"} | {i + 1: name for i, (name, _) in enumerate(held)}
    assert {"BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "LGPL-2.1", "AGPL-3.0", "EPL-2.0", "Zlib"} <= set(names.values())


def test_size_bounds_leave_no_match_out():
    for size in range(1, 60):
        least, most = license_scan.bounds(size, 0.8)
        for other in range(1, 200):
            if 2 * min(size, other) / (size + other) >= 0.8:
                assert least <= other <= most


def test_license_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = sorted(con.sql(license_scan.scan_sql()).fetchall(), key=str)
    got = license_scan.scan(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected
    assert expected
