"""Curated rules by example, mined rules against a plain count of all combinations."""

import random
from itertools import combinations

from terrapipe.llm.queries import URL_RULES
from terrapipe.llm.url_rules import judge, mine

URLS = [
    ("https://WWW.Example.NET/de/1", "www.example.net", "/de/1", "net/"),
    ("https://www.example.net/en/1?x=/fr/", "www.example.net", "/en/1", "example.net/en/"),
    ("https://badexample.net/en/1", "badexample.net", "/en/1", "net/"),
    ("http://net/", "net", "/", "net/"),
    ("http://a.net", "a.net", "", None),
    ("http://a.net?q=1", "a.net", "", None),
    ("http://a.net#/x", "a.net", "", None),
    ("http://internet/x", "internet", "/x", None),
    ("http://example.com/de/", "example.com", "/de/", "example.com/de/"),
    ("http://example.com/DE/", "example.com", "/DE/", None),
    ("http://m.example.org/fr/x#top", "m.example.org", "/fr/x", "org/fr/"),
    ("http://a.org/x://b.net/y", "a.org", "/x://b.net/y", None),
    ("://x.net/y", "x.net", "/y", "net/"),
    ("http:///y", "", "/y", None),
    ("no address", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
]
VERDICT = {rule: verdict for verdict, rule in URL_RULES}


def test_curated(spark):
    pages = spark.createDataFrame([(k, u, "h", True, "p") for k, (u, *_) in enumerate(URLS)] + [(None, "http://x.net/", "h", None, "p")] * 2,
                                  "page_id long, url string, host string, bad boolean, tokens string")
    none = spark.createDataFrame([], "id long, bad boolean")
    rows = judge(pages, none, URL_RULES).collect()
    assert len(rows) == len(URLS) + 2 and [r.rule for r in rows if r.page_id is None] == ["net/"] * 2
    for r in rows:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule) == URLS[r.page_id][1:]
            assert r.verdict == VERDICT.get(r.rule, "allow")
    assert judge(pages.limit(0), none, URL_RULES).collect() == []


def pages_and_labels(spark):
    rng = random.Random(3)
    rows = []
    for k in range(600):
        host = rng.choice(["farm.example.com", "shop.example.com", "blog.example.org"])
        lang, key = rng.choice(["en", "de"]), rng.choice(["", "?ref=x", "?utm=1&ref=y"])
        bad = rng.random() < (0.95 if host.startswith("farm") and lang == "de" else 0.9 if "utm" in key and host.startswith("shop") else 0.1)
        rows.append((k, f"https://{host}/{lang}/{k}{key}", bad))
    pages = spark.createDataFrame([(k, u) for k, u, _ in rows], "id long, url string")
    labels = spark.createDataFrame([(k, b) for k, _, b in rows if k % 3] + [(None, True), (5, None), (10_000, True)], "id long, bad boolean")
    return rows, pages, labels


def tokens(url):
    from re import sub
    rest = url.split("://")[1]
    rest, _, query = rest.partition("?")
    host, *path = rest.split("/")
    plain = [("host", x) for x in host.split(".")] + [("path", sub("[0-9]+", "0", x)) for x in path]
    return {"scheme:https", *(f"{k}:{x}" for k, x in plain), *(f"key:{x.split('=')[0]}" for x in query.split("&") if x)}


def test_mined_rules_equal_all_combinations(spark):
    rows, pages, labels = pages_and_labels(spark)
    seen = [(tokens(u), b) for k, u, b in rows if k % 3]
    expected = {}
    for size in range(1, 10):
        for some in {c for t, _ in seen for c in combinations(sorted(t), size)}:
            all_, bad = sum(t.issuperset(some) for t, _ in seen), sum(t.issuperset(some) and b for t, b in seen)
            for label, of in ((True, bad), (False, all_ - bad)):
                if of >= 0.05 * len(seen) and of >= 0.6 * all_:
                    expected[some, label] = (round(of / len(seen), 9), round(of / all_, 9))
    found = {(tuple(r.tokens), r.bad): (round(r.support, 9), round(r.confidence, 9)) for r in mine(pages, labels, 0.05, 0.6).collect()}
    assert found == expected and expected


def test_mined_rules_judge_every_page(spark):
    rows, pages, labels = pages_and_labels(spark)
    pages = pages.unionByName(spark.createDataFrame([(k, "https://farm.example.com/de/9") for k in range(1000, 1400)] + [(None, None)], pages.schema))
    found = judge(pages, labels, URL_RULES, id_column="id", min_support=0.05).collect()
    rules = mine(pages, labels, 0.05).collect()
    assert len(found) == 1001 and rules
    urls = {k: u for k, u, _ in rows}
    for r in found:
        if r.id is None:
            assert r.verdict == "allow"
        elif r.id >= 1000:
            assert r.verdict == "block" and r.rule == "example.com/de/"
        elif r.rule is None:
            fit = [(x.confidence, x.support, x.bad) for x in rules if tokens(urls[r.id]).issuperset(x.tokens)]
            assert r.verdict == ("block" if fit and max(fit)[2] else "allow")
    blocked = {r.id for r in found if r.verdict == "block" and r.rule is None}
    assert any("shop" in urls[i] for i in blocked) and not any("blog" in urls[i] for i in blocked)


def test_long_urls_and_many_tokens(spark):
    long = "http://a.b/" + "/".join(f"s{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(600)) + "?" + "&".join(["k=" + "v" * 50_000] * 3)
    pages = spark.createDataFrame([(k, long) for k in range(50)] + [(60, "http://c.d/")], "id long, url string")
    labels = spark.createDataFrame([(k, k < 45) for k in range(61)], "id long, bad boolean")
    found = judge(pages, labels, [], id_column="id").collect()
    assert sum(r.verdict == "block" for r in found) == 50 and {len(r.because or []) for r in found} <= set(range(13))
