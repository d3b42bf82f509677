"""URL rules against a rule-by-rule brute force."""

import random
import re

from tidewell.llm import urlfilter


def brute(url, rules, default="allow"):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [
        (-len(h + p), action, h + p)
        for h, p, action in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = min(fit, default=(0, default, None))
    return host, path, best[2], best[1]


def test_random_hosts_and_nested_rules(spark):
    rng = random.Random(5)
    labels = ["a", "b", "net", "org", "x-y", "é", ""]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
    path = lambda: "/" + "/".join(rng.choice(["en", "e", "de", ""]) for _ in range(rng.randrange(3)))
    rules = {(h, p): rng.choice(["allow", "block"]) for h, p in ((host(), path()) for _ in range(60)) if h}
    rules = [(h, p, a) for (h, p), a in rules.items()]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{host()}{rng.choice([path(), '', '?q=/en/', '#/de'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "http://", "://", "a://b://net/", "http://A.NET/En/\nx", "http://net:80/", "http://u@net/e"]
    urls += ["http://hot.net/en/1"] * 300
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
    got = urlfilter.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, action string"))
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert rows == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_clashing_columns_ties_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.net/x", "k", 7, "old"), (None, "http://a.net/x", "k", 7, None)],
        "page_id long, url string, key string, label int, verdict string",
    )
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("net", "/", "allow"), ("net", "/", "allow"), (None, "/", "block")],
        "host string, path string, action string",
    )
    got = urlfilter.filter_urls(pages, rules)
    assert got.columns == ["page_id", "url", "key", "label", "host", "path", "rule", "verdict"]
    assert [(r["key"], r["label"], r["rule"], r["verdict"]) for r in got.collect()] == [("k", 7, "net/", "allow")] * 2
    none = urlfilter.filter_urls(pages, rules.limit(0), default="block")
    assert [(r["rule"], r["verdict"]) for r in none.collect()] == [(None, "block")] * 2
    assert urlfilter.filter_urls(pages.limit(0), rules).count() == 0
