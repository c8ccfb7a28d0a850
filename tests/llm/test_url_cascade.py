"""URL rules and cascades against brute force."""

from junctura.llm.url_cascade import Cascade, Rule, build_cascade, build_parted, judge_urls, match_rule, site
from pyspark.sql import functions as F

import pytest

RULES = [Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block")]
URLS = [None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?q#f", "https://example.org/en/12", "http://example.org", "x://badexample.org/es/", "http://b.com/de/", "http://b.com/fr?x", "http://b.com/fr/#", "http://É.com\n/fr/", "a://b://c/d", "http://spam.b.net/x", "http://www.spam.b.net", "http://xspam.b.net/", "http://spam.b.net/x"]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    listed = ".".join(host.split(".")[-3:]) == "spam.b.net"
    return host, path, best.text if best else None, best.verdict if best else "block" if listed else "allow"


def test_matches_brute_force(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[4], "y")], "page_id long, url string, host string")
    listed = spark.createDataFrame([("spam.b.net",), ("never.seen.org",), (None,)], "key string")
    got = judge_urls(df, RULES, listed).collect()
    want = [(i, *brute(u)) for i, u in enumerate(URLS)] + [(None, *brute(URLS[4]))]
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str) == sorted(want, key=str)
    plan = judge_urls(df, RULES, listed)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_cascade_is_exact(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 3000, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = build_cascade(listed.unionByName(listed), universe)
    assert len(cascade.levels) > 2
    judged = universe.withColumn("is", cascade.listed(F.col("key"))).where("is <> (cast(substring(key, 2) as int) % 7 = 0)")
    assert judged.count() == 0
    assert sum(x.bits for x in cascade.levels) < 3000 * 8


@pytest.mark.parametrize("part_bits", [100, 1_000, 1 << 20])
def test_parted_cascades_are_exact(spark, part_bits):
    universe = spark.range(5_000).select(F.concat(F.lit("k"), "id").alias("key"))
    outside = spark.createDataFrame([("not in it",), (None,), ("k3",)], "key string")
    listed = spark.range(0, 5_000, 7).select(F.concat(F.lit("k"), "id").alias("key")).unionByName(outside)
    cascade = build_parted(listed.unionByName(listed), universe, part_bits)
    assert cascade.parts == 1 if part_bits == 1 << 20 else cascade.parts > 1
    assert len(cascade.levels) > 2
    known = {r.key for r in cascade.with_listed(universe).where("listed").collect()}
    assert known == {f"k{i}" for i in range(0, 5_000, 7)} | {"k3"}
    assert {r.listed for r in cascade.with_listed(spark.createDataFrame([("not in it",)], "key string")).collect()} == {True}
    assert {r.listed for r in cascade.with_listed(spark.createDataFrame([(None,)], "key string")).collect()} == {False}
    none = build_parted(listed.limit(0), universe, part_bits)
    assert none.levels == () and none.with_listed(universe).where("listed").count() == 0


def test_empty_and_large(spark):
    empty = spark.createDataFrame([], "key string")
    urls = spark.createDataFrame([(1, "http://a.b.c/")], "page_id long, url string")
    assert judge_urls(urls, [], empty).first().verdict == "allow"
    assert judge_urls(urls.limit(0), RULES, empty).collect() == []
    assert build_cascade(empty, empty) == Cascade(())
    with pytest.raises(ValueError):
        build_cascade(spark.range(1000).select(F.col("id").cast("string").alias("key")), empty, max_bits=500)
    assert spark.range(1).select(site(F.lit("a.b.c.d")).alias("s"), match_rule([], F.lit("a"), F.lit("/")).alias("m")).first() == ("b.c.d", None)


def test_listed_keys_of_any_length(spark):
    hosts = {"evil.com": True, "www.evil.com": True, "a.b.evil.com": True, "xevil.com": False, "com": False, "p.q.r.s": True, "o.p.q.r.s": True, "q.r.s": False, "x.r.s": False, "zone": True, "a.zone": True, "": False}
    listed = spark.createDataFrame([("evil.com",), ("p.q.r.s",), ("zone",)], "key string")
    urls = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id long, url string")
    assert {r.host: r.listed for r in judge_urls(urls, [], listed).collect()} == hosts


def test_long_lists_give_the_same_verdicts(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 3)] + [(None, None), (9, "http://" + "a." * 60 + "spam.b.net/" + "x" * 100_000)], "page_id long, url string")
    listed = spark.createDataFrame([("spam.b.net",), ("b.com",), ("",), (None,)] + [(f"k{i}.org",) for i in range(200)], "key string")
    short = sorted(map(str, judge_urls(df, RULES, listed).collect()))
    assert sorted(map(str, judge_urls(df, RULES, listed, max_bits=100).collect())) == short and len(short) == len(URLS) * 3 + 2
