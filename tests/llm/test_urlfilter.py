import pytest

from tradeloom.llm import urlfilter
from tradeloom.llm.queries import URL_RULES, op7_urlfilter

URLS = [
    None, "", "nothing", "http://", "://x.net/", "http://A.Example.NET/en/1", "https://example.net/en", "http://net/x", "http://net",
    "http://cabinet/x", "http://x.org/fr/", "http://x.org/fr", "http://x.org/de/#/fr/", "http://example.com/de/?q=://a.net/",
    "http://EXAMPLE.com/DE/", "ftp://user@b.example.com:80/de/", "http://b.example.com/de/x", "http://a.net?x/", "http://a.net#/",
    "http://\u00c4.net/\u00e4", "http://..net/", "http://net./", "a://b://c.net/",
] + ["http://hot.net/page"] * 50 + ["http://x.net/" + "y/" * 20_000]


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for rule, verdict in rules:
        rule_host, slash, rest = rule.partition("/")
        if host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rest):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, best and best[0], best[1] if best else "allow"


def judged(spark, urls, rules, **more):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, best string")
    out = urlfilter.judge(pages, "url", spark.createDataFrame(rules, "rule string, verdict string"), **more).collect()
    assert all(r["best"] == "mine" for r in out)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}


@pytest.mark.parametrize("blocks", [0, 1, 4096])
def test_like_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(urlfilter, "MAX_BLOCKS", blocks)
    rules = URL_RULES + [(f"h{i}.example/p{i}/", "block") for i in range(2000)]
    urls = URLS + [f"http://h{i}.example/p{j}/z" for i in range(0, 2000, 50) for j in (i, i + 1)]
    got = judged(spark, urls, rules)
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_the_filter_passes_every_listed_key_and_few_others(spark):
    listed = spark.range(5000).selectExpr("CONCAT('k', id) AS k")
    others = spark.range(5000).selectExpr("CONCAT('o', id) AS k")
    blocks = 5000 * urlfilter.BITS_PER_KEY // 512 + 1
    bloom = urlfilter.blocked_bloom(listed, "k", blocks)
    assert bloom.count() <= blocks
    assert urlfilter.possible_hits(listed, "k", bloom, blocks).count() == 5000
    assert urlfilter.possible_hits(others, "k", bloom, blocks).count() < 100


def test_the_filter_grows_with_the_list(spark):
    """A million keys fill as large a part of their filter as a thousand: it passes as few others."""
    shares = []
    for n in (1_000, 1_000_000):
        blocks = urlfilter.blocks_for(n)
        bloom = urlfilter.blocked_bloom(spark.range(n).selectExpr("CONCAT('k', id) AS k"), "k", blocks)
        others = spark.range(20_000).selectExpr("CONCAT('o', id) AS k")
        shares.append(urlfilter.possible_hits(others, "k", bloom, blocks).count() / 20_000)
    assert urlfilter.blocks_for(1_000_000) > 4096 and max(shares) < 0.02, shares


def test_keys_of_a_url_follow_its_own_host(spark, monkeypatch):
    """A list of many path lengths makes keys for the hosts that have them, not for every url."""
    rules = [(f"long.example/{'p' * n}/", "block") for n in range(300)] + [("other.example/x/", "block")]
    seen = []
    real = urlfilter.looked_up

    def counted(rows, key, listed, count):
        seen.append(rows.count())
        return real(rows, key, listed, count)

    monkeypatch.setattr(urlfilter, "looked_up", counted)
    urls = [f"http://a{i}.other.example/x/{'y' * 400}" for i in range(50)] + [f"http://no{i}.example/{'z' * 400}" for i in range(50)]
    got = judged(spark, urls, rules)
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}
    assert seen[1] == 50, seen  # one key for each url of the listed host, none for the others


def test_no_rules_no_pages_and_rules_given_twice(spark):
    assert judged(spark, URLS[:3] + ["http://a.net/"], []) == {0: ("", "", None, "allow"), 1: ("", "", None, "allow"),
                                                             2: ("", "", None, "allow"), 3: ("a.net", "/", None, "allow")}
    assert judged(spark, [], URL_RULES) == {}
    twice = judged(spark, ["http://a.net/"], [("net/", "allow"), ("net/", "block"), (None, "block"), ("/x", "block")])
    assert twice == {0: ("a.net", "/", "net/", "block")}


def test_query(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: tuple(r)[1:] for r in op7_urlfilter(spark, sf).select("page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {p["page_id"]: plain(p["url"], URL_RULES) for p in pages}
