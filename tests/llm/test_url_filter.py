"""URL filters against a check of every page with every rule."""

import random

from pyspark.sql import functions as F

from wardwatch.llm.url_filter import judge_urls

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pages, rules, default="allow"):
    best = {}
    for host, path, verdict in rules:
        if None not in (host, path, verdict) and host:
            key = (host.translate(UP), path)
            best[key] = max(best.get(key, ""), verdict)
    out = []
    for page_id, url in pages:
        rest = (url or "").partition("://")[2]
        cut = min([len(rest), *(rest.find(c) for c in "/?#" if c in rest)])
        host, tail = rest[:cut].translate(UP), rest[cut:]
        path = tail[:min([len(tail), *(tail.find(c) for c in "?#" if c in tail)])]
        fits = [(len(h) + len(p), len(h), h + "/" + p.removeprefix("/"), v) for (h, p), v in best.items()
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits) if fits else (0, 0, None, default)
        out.append((page_id, host, path, rule[2], rule[3]))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    rng = random.Random(3)
    names, parts = ["com", "net", "a.com", "b.a.com", "x.b.a.com", "ab.com", "é.net", "net.com"], ["/", "/en/", "/en/a", "/en", "", "/é/", "/e\u0000"]
    rules = [(rng.choice(names), rng.choice(parts), rng.choice(["allow", "block"])) for _ in range(30)]
    rules += [("A.Com", "/EN/", "block"), (None, "/", "block"), ("com", None, "block"), ("", "/", "block"), ("com", "/z", None)]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(['', 'www.', 'X.'])}{rng.choice(names)}{rng.choice(['', '.', ':80'])}"
            f"{rng.choice(parts)}{rng.choice(['', 'a', 'x/y'])}{rng.choice(['', '?q=/en/', '#top', '?a#b'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "a://b://c/d", "http://", "http:///en/", "x://com/" + "y" * 50_000, "http://a.com/en/"]
    pages = [(i if i % 7 else None, u) for i, u in enumerate(urls + ["http://www.a.com/en/a"] * 200)] + [(1, urls[1])] * 3
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("key", F.lit(1))
    got = sorted(map(tuple, judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()), key=repr)
    assert got == brute(pages, rules)


def test_no_rule_and_no_page(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    assert [tuple(r) for r in judge_urls(pages, rules.limit(0), default="block").collect()] == [(1, "a.com", "/", None, "block")]
    assert judge_urls(pages.limit(0), rules).count() == 0
