"""URL rules against running every rule on every URL."""

import random
import re

import pytest

from bidtrail.llm import url_rules
from bidtrail.llm.queries import op9_url_rules

URLS = [
    "http://a.net", "http://a.net/", "HTTP://WWW.Example.NET/en/1?q#f", "https://example.net/en/", "https://example.net/en", "https://notexample.net/en/x",
    "https://m.example.com/de/4.html", "https://m.example.com/DE/4", "http://x.org/fr/9", "org/fr/", "://", "x://?a", "https://casino.example.com/en/1", "https://my-casino.example.net/en/2",
    "https://casinos.example.com/", "https://free-bets.example.com", "https://example.com/casino/", "https://www.spam-farm.example.org/fr/1", "https://example.com#://other.net/",
    "https://é.example.net/en/ü", "http://host:80/a//b", "", None, "no scheme", "https://net/", "https://example.net.evil.com/en/",
]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    hits = [r for r in rules if re.search(r.pattern, host + path)]
    named = sorted((r for r in hits if r.name is not None), key=lambda r: -len(r.name))
    best = named[0] if named else hits[0] if hits else None
    return host, path, best.name if best else None, best.action if best else "allow"


def test_against_every_rule(spark):
    rng = random.Random(1)
    urls = URLS + [f"http://{rng.choice(['www.', ''])}{rng.choice(['poker', 'a', 'x-slots', 'slots-x'])}.{rng.choice(['net', 'org', 'example.net'])}/{rng.choice(['en', 'fr', ''])}/{i}" for i in range(80)]
    pages = spark.createDataFrame([(i, u, "verdict") for i, u in enumerate(urls + ["http://" + "a" * 20_000 + ".net/"] * 2)], "page_id bigint, url string, host string")
    got = {r["page_id"]: tuple(r)[2:] for r in url_rules.judge(pages).collect()}
    assert len(got) == len(urls) + 2
    for i, u in enumerate(urls):
        assert got[i] == plain(u, url_rules.RULES), u
    assert url_rules.judge(pages.where("false")).collect() == []


def test_only_fetched_rules_run_and_no_shuffle(spark):
    rules = [url_rules.site_rule("block", "a.example/x/y"), url_rules.Rule("block", "[0-9]{5}$", ())]
    assert rules[0].tokens == ("a", "example", "x")
    pages = spark.createDataFrame([(1, "http://a.example/x/yz"), (2, "http://b.example/12345"), (3, "http://a.example/")], "page_id bigint, url string")
    judged = url_rules.judge(pages, rules)
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in judged.collect()} == {1: ("a.example/x/y", "block"), 2: (None, "block"), 3: (None, "allow")}
    assert "Exchange" not in judged._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rules", [[], [url_rules.NAMED_RULES[0]]])
def test_few_rules(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert url_rules.judge(pages, rules).first()["verdict"] == ("block" if rules else "allow")


def test_query(spark):
    assert op9_url_rules(spark, "/root/testdata/sf0.001").count() == 50


def test_many_rules(spark):
    """20,000 rules give what the few that fit give alone, without a shuffle."""
    rules = [url_rules.site_rule("block" if i % 3 else "allow", f"h{i}.example/p{i % 7}/") for i in range(20_000)] + url_rules.RULES
    urls = [f"https://www.h{i * 37}.example/p{i * 37 % 7 if i % 2 else 9}/x" for i in range(300)] + ["https://poker.h5.example/p5/", "https://my-casino.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    judged = url_rules.judge(pages, rules)
    assert "Exchange" not in judged._jdf.queryExecution().executedPlan().toString()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judged.collect()}
    for i, u in enumerate(urls):
        near = [r for r in rules if r.name is None or any(t in u for t in r.tokens[:1])]
        assert got[i] == plain(u, near), u


def test_cost_of_a_url_does_not_follow_the_rules(spark):
    """The slot that a token reads stays short."""
    sizes = [max(map(len, url_rules.in_slots([(f"t{i}", i) for i in range(n)]))) for n in (30, 20_000)]
    assert sizes[0] <= 4 and sizes[1] <= 10
