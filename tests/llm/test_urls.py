from __future__ import annotations

import random

from repopulse.llm import urls

RULE = "verdict string, host string, path string"


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:end].translate({i: i + 32 for i in range(65, 91)})
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return host, path[:stop]


def plain(url, rules):
    host, path = parsed(url)
    fitting = [
        (len(h) + len(p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fitting)[2:] if fitting else (None, "allow")))


def judged(spark, pages, rules):
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    found = urls.judge(spark, frame, spark.createDataFrame(rules, RULE)).collect()
    return {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}


ODD = [
    None, "", "no scheme", "http://", "http:///p", "HTTP://EXAMPLE.Org/Es/1", "x://a://b/c", "https://a.b?x=/d/",
    "https://a.b#/d/", "http://a.b:80/d/", "http://.a.b/d/", "http://a..b/d/", "http://b/d/e/f?q#r", "http://é.b/d/é",
    "http://a.b/d/" + "x" * 5000, "http://" + "s." * 3000 + "b/d/", "http://a.b/d/", "http://a.b/d/", "ftp://a.b\n/d/",
]


def test_equals_trying_every_rule(spark):
    rng = random.Random(5)
    hosts = ["b", "a.b", "x.a.b", "c", "a.c", "ab", "b.a"]
    paths = ["", "/", "/d", "/d/", "/d/e", "/d/e/", "/dd", "/d/e/f"]
    pages = ODD + [
        f"http://{rng.choice(['', 'x.', 'y.x.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '1', 'z/'])}"
        for _ in range(300)
    ]
    for seed in range(3):
        rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(14)]
        # Of equal rules that blocks counts.
        assert judged(spark, pages, rules) == {i: plain(u, rules) for i, u in enumerate(pages)}


def test_rules_carry_over_many_partitions(spark):
    pages = [f"http://h{i % 50}.b/d/{i}" for i in range(400)]
    rules = [("block", "b", "/d/"), ("allow", "b", "/d/1"), ("block", "h7.b", "/")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert judged(spark, pages, rules) == {i: plain(u, rules) for i, u in enumerate(pages)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_tables_and_clashing_names(spark):
    pages = spark.createDataFrame(
        [(None, None, "x", "k"), (1, "http://a.b/d", "x", "k")], "page_id long, url string, host string, rule string"
    )
    rules = spark.createDataFrame([("block", "b", None), (None, None, "/")], RULE)
    assert [r["verdict"] for r in urls.judge(spark, pages, rules).orderBy("row.page_id").collect()] == ["allow", "block"]
    left = urls.allowed(spark, pages, rules)
    assert left.columns == pages.columns and left.count() == 1
    assert urls.judge(spark, pages, rules.limit(0)).where("verdict = 'allow'").count() == 2
    assert urls.judge(spark, pages.limit(0), rules).count() == 0
