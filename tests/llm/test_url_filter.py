from __future__ import annotations

import re

from tonnage.llm.url_filter import SITE_RULES, WORD_RULES, judge_urls, rule_table, site_rule

URLS = [
    "http://a.example.org/es/1", "https://example.org/en/12?q=/es/", "HTTP://EXAMPLE.ORG/en/1", "http://org/", "http://org",
    "http://notexample.org.net/es/", "http://x.com/fr/1#t", "http://x.com/de", "http://x.com/de/", "http://casino.com/fr/",
    "http://my-casino.net/", "http://casinos.net/", "ftp://u:p@sex.example.com:80/de/x", "no scheme", "", None, "http://", "x://y://z.org/",
    "http://poker.org/", "http://é.com/de/", "http://a.com/DE/", "http://xorg/", "http://a.org/es/", "http://\n.com/fr/", "http://bets.com?x=/fr/",
]


def expected(url, sites, words):
    found = re.search("://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rule, verdict = None, None
    for name, what in sites.items():
        of_host, slash, of_path = name.partition("/")
        fits = (host == of_host or host.endswith("." + of_host)) and path.startswith(slash + of_path)
        if fits and len(name) > len(rule or ""):
            rule, verdict = name, what
    blocked = set(re.split("[^a-z0-9]", host)) & words
    return host, path, rule, verdict or ("block" if blocked else "allow")


def run(spark, rows, rules):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, address string, token string, host int")
    found = judge_urls(pages, rule_table(spark, rules))
    assert set(pages.columns) <= set(found.columns)
    return [tuple(r) for r in found.select("page_id", "host", "path", "rule", "verdict").collect()]


def test_registered_rules(spark):
    rows = [(i, u, "h", "a", "t", 1) for i, u in enumerate(URLS * 2)] + [(None, URLS[0], None, None, None, None)]
    sites, words = {r.name: r.verdict for r in SITE_RULES}, {r.name for r in WORD_RULES}
    want = [(i, *expected(u, sites, words)) for i, u, *_ in rows]
    assert sorted(run(spark, rows, SITE_RULES + WORD_RULES), key=str) == sorted(want, key=str)


def test_rules_of_other_kinds(spark):
    rules = [site_rule("block", "A.b"), site_rule("allow", "a.b/x+y("), site_rule("block", "é.de/")]
    urls = ["http://a.b", "http://A.B/x+y(1", "http://a.b/x", "http://q.é.de/", "http://aab/", "http://a.bc/"]
    got = run(spark, [(i, u, "", "", "", 0) for i, u in enumerate(urls)], rules)
    assert [r[3:] for r in sorted(got)] == [
        ("a.b", "block"), ("a.b/x+y(", "allow"), ("a.b", "block"), ("é.de/", "block"), (None, "allow"), (None, "allow"),
    ]


def test_no_pages_and_native_plan(spark):
    assert run(spark, [], SITE_RULES) == []
    pages = spark.createDataFrame([], "page_id long, url string")
    plan = judge_urls(pages, rule_table(spark, SITE_RULES))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
