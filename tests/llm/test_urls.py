import random

from helpers import with_clashing

from yieldlens.llm.queries import URL_RULES
from yieldlens.llm.urls import judge_urls, rule_table


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [i for i, c in enumerate(rest) if c in "/?#"]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[: ends[0]] if ends) if ends else "".join(
        c.lower() if "A" <= c <= "Z" else c for c in rest
    )
    tail = rest[ends[0] :] if ends else ""
    cut = [i for i, c in enumerate(tail) if c in "?#"]
    path = tail[: cut[0]] if cut else tail
    fits = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def urls_of(n=400):
    r = random.Random(3)
    hosts = ["net", "a.net", "example.net", "b.example.net", "xexample.net", "example.com", "de.example.com", "org", "q.org", "net.org", "EXAMPLE.net", "", "net:80", "org\x01x", "x.example.net\x01", "org\x02", "a\x01.org", "\x01org", "org\x02\x02x"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/1", "/fr", "/en/é\n", "//en/"]
    tails = ["", "?a=/en/", "#/de/", "?x://y"]
    return [r.choice(["http://", "", "HTTPS://", "a://b://"]) + r.choice(hosts) + r.choice(paths) + r.choice(tails) for _ in range(n)]


def test_against_brute_force(spark):
    urls = [None, "", "://", "http://", "x" * 200_000, "http://" + "a." * 5000 + "net/" + "y" * 100_000, *urls_of()]
    pages = with_clashing(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").drop("host"))
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, rule_table(spark, URL_RULES)).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        assert rows[i] == brute(u, URL_RULES), u


def test_nested_and_odd_rules(spark):
    rules = [("net", "/", "block"), ("a.net", "/x/", "allow"), ("a.net", "/x/y/", "block"), ("b.a.net", "/", "allow"), ("B.net", None, "block")]
    odd = [*rules, (None, "/", "block"), ("", "/", "block"), ("c.net", "/", None), ("net", "/", "allow")]
    urls = ["h://net/", "h://a.net/x/1", "h://a.net/x/y/1", "h://b.a.net/x/y/1", "h://b.a.net/q", "h://z.b.net", "h://c.net/", "h://aa.net/x/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    plain = [(h.lower(), p or "", v) for h, p, v in rules]
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, rule_table(spark, odd)).collect()}
    assert rows == {i: brute(u, plain) for i, u in enumerate(urls)}


def test_rules_with_separators(spark):
    rules = [("org", "/", "block"), ("org\x01x", "/", "allow"), ("x.org", "/", "allow"), ("org\x02", "/", "block"), ("\x01", "", "block")]
    hosts = ["org", "org\x01x", "x.org", "a.x.org", "org\x02", "b.org\x02", "org\x02\x02x", "\x01", "q.\x01", "a.org\x01x", "org\x01"]
    pages = spark.createDataFrame([(i, f"h://{h}/") for i, h in enumerate(hosts)], "page_id long, url string")
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, rule_table(spark, rules)).collect()}
    assert rows == {i: brute(f"h://{h}/", rules) for i, h in enumerate(hosts)}


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(none, rule_table(spark, URL_RULES)).count() == 0
    same = spark.createDataFrame([(None, "h://a.net/")] * 3, "page_id long, url string")
    assert [tuple(r) for r in judge_urls(same, rule_table(spark, [])).collect()] == [(None, "a.net", "/", None, "allow")] * 3
