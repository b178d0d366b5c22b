import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import url_rules


def split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[cut:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rest[:cut].translate(lower), tail[:stop]


def brute(url, rules):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, None, "allow")
    return host, path, best[2], best[3]


def run(spark, urls, rules):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = url_rules.judge(pages, table).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}, len(rows)


def test_contract_rules(spark):
    from plumbline.llm.queries import RULES

    urls = ["http://a.example.NET/en/1?x#y", "https://example.net/de/", "http://example.net", "http://net/", "x", None,
            "", "http://", "https://s.example.com/de/#a", "http://w.org/fr/x", "http://w.org/frx/", "http://notexample.com/de/",
            "ftp://example.net?/en/", "http://example.net/en", "a://b://c.net/x", "http://EXAMPLE.net/EN/", "http://é.net/é"]
    found, n = run(spark, urls, RULES)
    assert n == len(urls) and found == {i: brute(u, RULES) for i, u in enumerate(urls)}


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_random_nested_rules(spark, coalesce):
    """Also with one range for every partition, so that the open stack goes from range to range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        nested_rules(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def nested_rules(spark):
    rng = random.Random(7)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "ab.com", "net", "x.net", "co", "a-b.com"]
    paths = ["/", "/a", "/a/", "/a/b", "/ab", "", "/z/é", "/a/b/c"]
    keys = {(rng.choice(hosts), rng.choice(paths)) for _ in range(30)}
    rules = [(h, p, rng.choice(["block", "allow"])) for h, p in sorted(keys)]
    urls = [f"http://{rng.choice(['', 'www.', 'q.r.s.'])}{rng.choice(hosts)}{rng.choice(['', '.uk'])}"
            f"{rng.choice(paths)}{rng.choice(['', 'b', '/b', 'c/d', '?q=/a'])}" for _ in range(400)]
    found, n = run(spark, urls + urls[:50], rules)
    assert n == 450
    for i, u in enumerate(urls):
        host, path, rule, verdict = brute(u, rules)
        assert found[i][:2] == (host, path)
        fits = [len(h) + len(p) for h, p, _ in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (found[i][2] is None) == (not fits)
        if fits:
            assert len(found[i][2]) == max(fits) and found[i][2:] == (rule, verdict)


def test_empty_tables_and_clashing_columns(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([("http://a.net/x", "own", 1)], "url string, host string, verdict int")
    row = url_rules.judge(pages, rules).first()
    assert (row["url"], row["host"], row["verdict"]) == ("http://a.net/x", "a.net", "block")
    assert url_rules.judge(pages.where("false"), rules).count() == 0
    assert url_rules.judge(pages, rules.where("false")).first()["verdict"] == "allow"


def test_columns_named_like_temporary_ones(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    names = ["__host__", "__path__", "__row__", "__rule__", "__verdict__", "a.b", "key"]
    pages = spark.createDataFrame([("http://a.net/x", *names)], ["url", *names])
    found = url_rules.judge(pages, rules)
    assert found.columns == ["url", *names, "host", "path", "rule", "verdict"]
    assert tuple(found.first()) == ("http://a.net/x", *names, "a.net", "/x", "net/", "block")


def test_a_hundred_thousand_rules_of_one_top_label(spark):
    """Three levels under ``com``, over several ranges: no task holds all of them, and the stack is carried on."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rules = spark.sql("""select 'com' as host, '/' as path, 'block' as verdict
            union all select concat('h', id, '.com'), '/', 'allow' from range(60000)
            union all select concat('h', id, '.com'), '/a/', 'block' from range(0, 60000, 2)
            union all select concat('h', id, '.com'), '/a/b', 'allow' from range(0, 60000, 4)""")
        edges = url_rules.boundaries(rules)
        assert edges.count() == 2 * (1 + 60000 + 30000 + 15000)
        sizes = [r["count"] for r in edges.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.7 * sum(sizes)
        pages = spark.sql("""select id, concat('http://w.h', id, '.com', element_at(array('/', '/a/', '/a/b', '/a'),
            cast(1 + id div 7 % 4 as int))) as url from range(0, 70000, 7)""")
        for r in url_rules.judge(pages, rules).collect():
            path, host = r["path"], f"h{r['id']}.com"
            want = "com/" if r["id"] >= 60000 else host + (
                "/a/b" if path == "/a/b" and r["id"] % 4 == 0
                else "/a/" if path in ("/a/", "/a/b") and r["id"] % 2 == 0 else "/")
            assert r["rule"] == want and r["verdict"] == ("block" if want in ("com/", host + "/a/") else "allow")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_same_rule_twice_blocks(spark):
    found, _ = run(spark, ["http://n.net/"], [("net", "/", "allow"), ("NET", "/", "block"), (None, "/", "block")])
    assert found[0][3] == "block"


def test_no_python_in_the_plan(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    pages = spark.range(5).select(F.lit("http://a.net/").alias("url"))
    plan = url_rules.judge(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
