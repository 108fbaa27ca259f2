import re

import pytest
from pyspark.sql import functions as F

from linkframe.llm import url_filter as U
from linkframe.llm.queries import HOST_RULES

URLS = [
    "http://www.example.com/en/1", "https://WWW.Example.COM/en/x?y#z", "http://a.www.example.com/en/", "http://example.com/en/1", "http://x.example.com/EN/1",
    "http://example.com", "http://example.com?x=/en/", "http://example.com/en", "http://notexample.com/en/1", "http://com/", "http://b.net/es/1",
    "http://net/fr/", "http://b.net/de/1", "http://casino-win.example.org/en/1", "http://b.org/online/poker/", "http://b.org/poker/online/", "http://casinos.org/",
    "no scheme", "", None, "://", "a://b://c/d", "http://b.org/x\ny?z", "http://é.net/es/ü", "http://b.net:80/es/", "http://b.net/es/1",
]
STRINGS = {"example.com/en/": "block", "net/es/": "block", "net/fr/": "block", "www.example.com/en/": "allow", "com/": "allow"}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def expected(url):
    host, path = parts(url)
    fits = [r for r in STRINGS for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    if fits:
        rule = max(fits, key=len)
        return host, path, rule, STRINGS[rule]
    spam = [r for r in U.SPAM if re.search(r.pattern, host + path)]
    best = min(spam, key=lambda r: (-r.rank, r.text), default=None)
    return host, path, best and best.text, "block" if best else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")


def test_verdicts_equal_brute_force(pages):
    out = U.judge(pages, HOST_RULES + U.SPAM).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in out] == [expected(u) for u in URLS]


def test_tokens_are_needed_by_the_pattern():
    for rule in HOST_RULES + U.SPAM:
        assert rule.tokens and all(t in rule.text for t in rule.tokens)
    partial = U.host_rule("a.com", "/en/sh", "block")  # "sh" may go on as "shop"
    assert partial.tokens == ("a", "com", "en")


def test_empty_rules_clashing_columns_and_empty_table(pages):
    assert {r["verdict"] for r in U.judge(pages, []).collect()} == {"allow"}
    clash = pages.withColumns({"host": F.lit(1), "rule": F.lit(2), "row_": F.lit(3), "token": F.lit(4), "body": F.lit(5), "best": F.lit(6)})
    out = U.judge(clash, HOST_RULES)
    assert out.where("rule = 'net/es/'").count() == 3 and set(out.columns) >= {"page_id", "token", "verdict"}
    assert U.judge(pages.limit(0), HOST_RULES).count() == 0


def test_no_python_in_the_plan(pages):
    plan = U.judge(pages, HOST_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_rules_without_a_token_run_on_every_url(spark):
    rules = [U.Rule("any.exe", r"\.exe$", (), "block", 5), U.Rule("named", r"setup", ("setup",), "allow", 9)]
    urls = ["http://a.b/x.exe", "http://a.b/setup.exe", "http://a.b/x.txt", None, "http://a.b/" + "long/" * 20_000 + "x.exe"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in U.judge(pages, rules).collect()}
    assert got == {0: ("any.exe", "block"), 1: ("named", "allow"), 2: (None, "allow"), 3: (None, "allow"), 4: ("any.exe", "block")}
