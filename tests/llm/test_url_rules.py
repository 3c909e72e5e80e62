"""URL rules by index against trying every rule."""

from __future__ import annotations

import re

from parcelscope.llm import url_rules
from parcelscope.llm.url_rules import Rule

URLS = [
    None, "", "no scheme", "http://", "https://Blog.Example.NET/en/1?x#y", "http://example.net/EN/1", "http://net/a", "http://x.net", "http://xnet/",
    "http://a.example.com/de/7", "http://example.com/deep", "http://w.org/fr/", "http://w.org/fr", "ftp://a.net?q=/en/", "http://a.net#/x",
    "http://m.casino-win.example.com/en/4033.html", "http://a.com/casino/news/1", "http://a.com/online-poker", "http://mycasino24.top/x",
    "http://mycasino24.com/x", "http://casinos.com/", "http://a.com/tracker/opt-out/", "http://law.com/viagra/law", "http://a.com/slots-casino/law/",
    "http://m.ads-track.example.com/en/1", "http://a.com/ads/1", "http://a.com/loads/1", "a://b://c.net/x", "http://ÄÖ.net/é\nx", "http://a.com/x/y/" + "z" * 50_000,
]


GENERAL = [(r, re.compile(url_rules.regex_of(r), re.S)) for r in url_rules.GENERAL]


def plain(url):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in url_rules.RULES:
        name, _, tail = rule.text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            fits.append(rule)
    if fits:
        best = max(fits, key=lambda r: len(r.text))
        return host, path, best.text, best.action
    own = [r for r, regex in GENERAL if regex.search(host + path)]
    return host, path, None, max(own, key=lambda r: len(r.text)).action if own else "allow"


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(4, URLS[4])] * 3 + [(None, URLS[9])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS rule", "1 AS address", "2 AS token")
    got = url_rules.judged(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(r["url"]), r["url"]
        assert r["address"] == 1 and r["token"] == 2


def test_rules_are_indexed_by_their_rarest_token(spark):
    addresses = spark.createDataFrame([("a.example.net/",), ("b.example.net/en",), ("c.net/",)], "address string")
    rules = [Rule("block", "example.net/"), Rule("allow", "q.net/x/"), Rule("block", "^*^", True)]
    found = {r["text"]: r["token"] for r in url_rules.indexed(rules, addresses).collect()}
    assert found == {"example.net/": "example", "q.net/x/": "q", "^*^": ""}


def test_every_rule_that_fits_is_fetched():
    odd = ["http://mycheap-pills.top/", "http://a.loan/", "http://x-poker7.win/", "http://a.com/casino-1/law"]
    addresses = ["".join(plain(url)[:2]) for url in URLS + odd]
    for rule in [*url_rules.RULES, *url_rules.GENERAL, Rule("block", "^ban*er^", True)]:
        regex, tokens = re.compile(url_rules.regex_of(rule), re.S), set(url_rules.tokens_of(rule))
        for address in addresses:
            if regex.search(address):
                assert tokens <= set(re.findall("[a-z0-9]+", address.lower()))


def test_many_rules_of_every_kind():
    rules = url_rules.GENERAL
    assert len(rules) > 400 and len({r.text for r in rules}) == len(rules)
    assert {r.action for r in rules} == {"allow", "block"} and any("*" in r.text for r in rules)
    verdicts = {u: plain(u)[3] for u in URLS}
    assert verdicts["http://m.casino-win.example.com/en/4033.html"] == "block" and verdicts["http://mycasino24.top/x"] == "block"
    for fine in ("http://casinos.com/", "http://mycasino24.com/x", "http://a.com/casino/news/1", "http://a.com/tracker/opt-out/"):
        assert verdicts[fine] == "allow"


def test_an_index_fetches_few_rules(spark):
    """No general rule needs every URL, and the pages of the table fetch hardly any."""
    addresses = spark.createDataFrame([("a.com/en/page-1.html",), ("b.org/news/1",), ("my-casino.com/x",)], "address string")
    index = url_rules.indexed(url_rules.GENERAL, addresses).collect()
    assert len(index) == len(url_rules.GENERAL) and all(r["token"] for r in index)
    fetched = [r for r in index if r["token"] in {"a", "b", "com", "en", "html", "org", "news", "page", "1", "my", "x"}]
    assert len(fetched) <= len(url_rules.ADVERTISING) + len(url_rules.SPAM)


def test_the_shuffled_join_gives_the_same(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        got = {r["page_id"]: r["verdict"] for r in url_rules.judged(pages).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: plain(u)[3] for i, u in enumerate(URLS)}


def test_empty(spark):
    assert url_rules.judged(spark.createDataFrame([], "page_id long, url string")).count() == 0
