"""URL rules against a plain loop over all rules."""

from __future__ import annotations

import pytest

from feedlake.llm import urls
from feedlake.llm.urls import ALLOW, BLOCK, Rule

RULES = [
    Rule("com", "/", ALLOW), Rule("example.com", "/en/", BLOCK), Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK), Rule("net", "/fr/", BLOCK), Rule("a.net", "/fr", ALLOW),
    Rule("x.org", "", BLOCK), Rule("dup.io", "/", ALLOW), Rule("dup.io", "/", BLOCK),
    Rule("ab.cd", "/x", ALLOW), Rule("cd", "/x/12", BLOCK), Rule("UP.de", "/", BLOCK),
]
URLS = [
    "http://example.com/en/1", "https://www.example.com/en/", "http://m.www.example.com/en/a?b#c",
    "http://notexample.com/en/", "HTTP://EXAMPLE.COM/EN/", "http://example.com", "http://example.com?q",
    "ftp://q.net/es/1", "http://q.net/es", "http://a.net/french", "http://b.a.net/fr/x", "http://q.net/fr/1",
    "http://x.org", "http://y.x.org?z", "http://dup.io/", "http://ab.cd/x/12", "http://up.de/", "//no.com/",
    "", None, "no scheme", "://com/", "http://com/", "http://.com/", "http://com./", "a://b://com/x",
    "http://" + "a." * 3000 + "com/" + "b/" * 3000, "http://q.net/fr/\n1",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def judged(url):
    host, path = parts(url)
    fits = [
        (len(r.host + r.path), len(r.host), r.verdict == BLOCK, r.host.lower() + r.path, r.verdict)
        for r in RULES
        if (host == r.host.lower() or host.endswith("." + r.host.lower())) and path.startswith(r.path)
    ]
    best = max(fits, default=(0, 0, 0, None, ALLOW))
    return host, path, best[3], best[4]


def test_rules(spark):
    rows = [(i, u, "h", "p", "v") for i, u in enumerate(URLS)] + [(None, URLS[0], "", "", ""), (0, URLS[0], "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string, verdict string")
    got = urls.judge_urls(pages, urls.rule_table(spark, RULES)).collect()
    wanted = sorted([(str(r[0]), *judged(r[1])) for r in rows], key=str)
    assert sorted([(str(r["page_id"]), *r[1:]) for r in got], key=str) == wanted


@pytest.mark.parametrize("default", [ALLOW, BLOCK])
def test_no_rules_and_no_pages(spark, default):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    none = urls.rule_table(spark, [])
    assert [tuple(r) for r in urls.judge_urls(pages, none, default=default).collect()] == [
        (1, "a.b", "/c", None, default)
    ]
    assert urls.judge_urls(pages.filter("false"), urls.rule_table(spark, RULES)).count() == 0


def test_plan_is_native(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    plan = urls.judge_urls(pages, urls.rule_table(spark, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
