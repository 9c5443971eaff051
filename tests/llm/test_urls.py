import numpy as np
import pytest

from compare import connect, oracle_rows, rows_of
from vigil.llm import url_filter
from vigil.llm.queries import ORACLES, QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"

URLS = [
    None, "", "no scheme", "a://", "http://a.net", "http://a.net/", "http://a.NET/x?y#z", "https://net/", "s://xnet/",
    "http://example.net/en/1", "http://www.Example.net/en/", "http://badexample.net/en/", "http://example.net/EN/",
    "http://example.com/de/x", "http://m.example.com/de", "http://x.org/fr/?a://b.net/", "x://y://a.net/", "?://a.net/",
    "http://a.net?x/", "http://a.net#/", "http://..net/", "http://net./", "http://[::1]:80/net/", "http://日本.net/ü/é",
    "http://" + "a." * 3000 + "net/" + "p" * 100_000, "http://" + "l" * 50_000 + "/", "http://a.net/\nx", "a\nb://c.net/d",
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]


def plain_judged(url, rules):
    host, path = plain_parts(url)
    best = None
    for rule, verdict in rules:
        own, slash, rest = rule.partition("/")
        if ("." + host).endswith("." + own) and path.startswith(slash + rest):
            rank = (len(rule), len(own), verdict == "block")
            if best is None or rank > best[0]:
                best = (rank, rule, verdict)
    return host, path, best and best[1], best[2] if best else "allow"


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "a", "b") for i, u in enumerate(urls)], "page_id long, url string, rule string, `found.x` string")
    table = spark.createDataFrame(rules, "rule string, verdict string")
    out = url_filter.judge_urls(pages, table, **options).orderBy("page_id").collect()
    assert [r.page_id for r in out] == list(range(len(urls)))
    return [(r.host, r.path, r.rule, r.verdict) for r in out]


def test_rules_of_the_query(spark):
    assert judged(spark, URLS, URL_RULES) == [plain_judged(u, URL_RULES) for u in URLS]


@pytest.mark.parametrize("options", [{}, {"rules_a_segment": 7}, {"mask": 3}, {"rules_a_segment": 9, "mask": 15}])
def test_many_rules_and_colliding_digests(spark, options):
    draw = np.random.default_rng(5)
    hosts = ["net", "a.net", "b.a.net", "org", "ü.org", "x", "c.x"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ü", "/üa"]
    rules = list({(h + p, str(draw.choice(["allow", "block"]))) for h in hosts for p in paths if draw.random() < 0.6})
    assert len({r for r, _ in rules}) > 20
    rules += [(rules[0][0], "block"), (rules[0][0], "allow")]
    urls = [f"http://{s}{h}{p}{t}" for h in hosts for p in paths for s in ("", "q.", "q") for t in ("", "z", "?a")] + URLS
    assert judged(spark, urls, rules, **options) == [plain_judged(u, rules) for u in urls]


def test_no_rules_no_pages_odd_rules(spark):
    assert judged(spark, URLS, []) == [(*plain_parts(u), None, "allow") for u in URLS]
    assert judged(spark, ["http://a.b/"], [(None, "block"), ("/x", "block")]) == [("a.b", "/", None, "allow")]
    assert judged(spark, [], URL_RULES) == []
    with pytest.raises(ValueError):
        judged(spark, [], [("net/", "deny")])


def test_table_equals_sql(spark):
    assert rows_of(QUERIES["op13_url_filter"](spark, SF)) == oracle_rows(connect(SF), ORACLES["op13_url_filter"])


def test_no_row_moves(spark):
    plan = QUERIES["op13_url_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan
