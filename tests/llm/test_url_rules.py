import random

import pytest

from riskflow.llm import url_rules

URLS = [
    ("http://EXAMPLE.com/en/x?q#f", "example.com", "/en/x", "example.com/en/", "block"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/b", "a.www.example.com", "/en/b", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("http://x.net/es", "x.net", "/es", None, "allow"),
    ("http://x.net/fr/?a=/es/", "x.net", "/fr/", "net/fr/", "block"),
    ("http://x.net?u=/fr/", "x.net", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("a://b://c/", "b:", "//c/", None, "allow"),
    ("http://ÀB.COM/", "Àb.com", "/", "com/", "allow"),
    ("http://com//en/\nx", "com", "//en/\nx", "com/", "allow"),
]


def test_verdicts(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.filter_urls(pages, url_rules.default_rules(spark)).collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}


def best(host, path, rules):
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else ("allow", None)


@pytest.mark.parametrize("seed", range(2))
def test_random_rules_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    label, part = lambda: rng.choice("abc"), lambda: rng.choice(["", "a", "b", "ab"])
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for _ in range(40)
                  for h in [".".join(label() for _ in range(rng.randint(1, 3)))]
                  for p in ["/" + "/".join(part() for _ in range(rng.randint(0, 3)))]}.values())
    urls = [(i, "http://" + ".".join(label() for _ in range(rng.randint(1, 4))) + "/" + "/".join(part() for _ in range(rng.randint(0, 4))))
            for i in range(300)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    got = url_rules.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    for r in got.collect():
        assert (r["verdict"], r["rule"]) == best(r["host"], r["path"], rules)


def test_empty_tables_repeats_and_deep_paths(spark):
    rules = url_rules.default_rules(spark)
    pages = spark.createDataFrame([(1, "http://x.net/es/" + "a/" * 20000), (1, "http://x.net/es/"), (None, "http://x.net/es/"),
                                   (None, "http://x.net/es/")], "page_id long, url string")
    assert [r["verdict"] for r in url_rules.filter_urls(pages, rules).collect()] == ["block"] * 4
    assert url_rules.filter_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_rules.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}
