"""Raking against numpy; probabilities and samples."""

import numpy as np
from pyspark.sql import functions as F

from junctura.llm.mixing import mix, rake, surface_topic, tokens, uniform
from junctura.llm.store import Scratch


def test_rake_matches_numpy(spark):
    r = np.random.default_rng(1)
    n = r.integers(1, 500, (4, 3, 2)).astype(float)
    n[0, 1, 1] = 0
    targets = [np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    f = [np.ones(4), np.ones(3), np.ones(2)]
    for _ in range(30):
        f[0] = targets[0] / np.einsum("ijk,j,k->i", n, f[1], f[2])
        f[1] = targets[1] / np.einsum("ijk,i,k->j", n, f[0], f[2])
        f[2] = targets[2] / np.einsum("ijk,i,j->k", n, f[0], f[1])
    rows = [(str(i), str(j), str(k), int(n[i, j, k])) for i in range(4) for j in range(3) for k in range(2)]
    table = spark.createDataFrame(rows, "m_source string, m_lang string, m_topic string, tokens long")
    tables = {m: spark.createDataFrame([(str(i), float(x)) for i, x in enumerate(t)], "key string, target double") for m, t in zip(["m_source", "m_lang", "m_topic"], targets)}
    got = rake(table, tables, 30, Scratch(spark, "test")).collect()
    for x in got:
        i, j, k = int(x.m_source), int(x.m_lang), int(x.m_topic)
        assert abs(x.factor - f[0][i] * f[1][j] * f[2][k]) < 1e-9
    assert abs(sum(x.factor * x.tokens for x in got) - 1) < 1e-9


def test_mix_meets_margins(spark):
    rows = [(i, "w " * (1 + i % 40), ["a", "a", "b", None][i % 4], ["en", "de", "en"][i % 3]) for i in range(4000)] + [(9000, None, "a", "en"), (None, "x", "zz", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("factor", F.lit("mine"))
    target = spark.createDataFrame([("a", 0.3), ("b", 0.5), ("(none)", 0.2), ("unseen", 0.4)], "key string, target double")
    out = mix(df, topic=F.lit("t"), targets={"m_source": target}, rounds=10).cache()
    assert out.count() == len(rows)
    by = {r.m_source: r.s for r in out.groupBy("m_source").agg(F.sum(F.col("m_tokens") * F.col("probability")).alias("s")).collect()}
    total = sum(by.values())
    assert abs(by["b"] / total - 0.5) < 1e-3 and abs(by["a"] / total - 0.3) < 1e-3
    assert out.agg(F.max("probability")).first()[0] <= 1.0
    taken = {r.m_source: r.s for r in out.where("sampled").groupBy("m_source").agg(F.sum("m_tokens").alias("s")).collect()}
    assert abs(taken["b"] / taken["a"] - by["b"] / by["a"]) < 0.3
    assert out.where("doc_id = 9000").first().probability == 1.0
    assert out.where("doc_id is null").first().probability == 0.0


def test_empty(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string, lang string"), rounds=2).collect() == []


def test_expressions(spark):
    row = spark.createDataFrame([("a\x0bb  c\n", "x | y"), (None, None)], "t string, u string").select(tokens(F.col("t")).alias("n"), surface_topic(F.col("u")).alias("s"), uniform(F.lit(5), F.col("t"), 1).alias("r")).collect()
    assert [(r.n, r.s) for r in row] == [(3, "table"), (0, "prose")] and 0 <= row[0].r < 1


def test_clashing_names_and_repeated_rows(spark):
    rows = [(1, "a b", "s", "en"), (1, "a b", "s", "en"), (2, None, None, None), (3, "x " * 100_000, "s", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    taken = df.withColumns({c: F.lit("mine") for c in ("m_source", "m_tokens", "sampled", "probability", "tokens", "key", "f", "rate")})
    plain, other = (sorted(map(str, mix(d, rounds=2).select("doc_id", "m_source", "m_tokens", "factor", "probability", "sampled").collect())) for d in (df, taken))
    assert plain == other and len(plain) == 4 and plain[0] == plain[1]
    assert mix(taken, rounds=2).select("tokens", "key", "f", "rate").distinct().collect() == [("mine",) * 4]


def test_rounds_end_before_convergence(spark):
    table = spark.createDataFrame([("a", "x", "t", 10), ("a", "y", "t", 1), ("b", "x", "t", 3), ("b", "y", "t", 90)], "m_source string, m_lang string, m_topic string, tokens long")
    targets = {"m_source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "key string, target double"), "m_lang": spark.createDataFrame([("x", 0.1), ("y", 0.9)], "key string, target double"), "m_topic": spark.createDataFrame([("t", 1.0)], "key string, target double")}
    off = []
    for rounds in (1, 2, 40):
        got = rake(table, targets, rounds, Scratch(spark, "test")).collect()
        off.append(abs(sum(x.tokens * x.factor for x in got if x.m_source == "a") - 0.9))
        # the margin that was met last holds after any round
        assert abs(sum(x.tokens * x.factor for x in got) - 1) < 1e-9
    assert off[0] > off[1] > off[2] and off[2] < 1e-6


def test_rows_without_id_are_drawn_one_by_one(spark):
    rows = [(None, f"text number {i} of this source", "a" if i % 10 == 0 else "b", "en") for i in range(4_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = mix(df, topic=F.lit("t"), powers=(0.5, 1.0, 1.0))
    by = {r.m_source: (r.n, r.p) for r in out.groupBy("m_source").agg(F.sum(F.col("sampled").cast("int")).alias("n"), F.avg("probability").alias("p")).collect()}
    assert by["a"] == (400, 1.0) and abs(by["b"][0] - 3_600 * by["b"][1]) < 120 and 0 < by["b"][1] < 0.5
