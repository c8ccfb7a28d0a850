"""Expressions against naive loops."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from junctura.functions import cigar as C
from junctura.functions import keys as K
from junctura.functions import numeric as N
from junctura.functions import sequence as S


@pytest.fixture(scope="module")
def seqs(spark):
    r = random.Random(1)
    rows = [("".join(r.choices("ACGT", k=r.randint(0, 60))), "".join(r.choices("AC", k=r.randint(0, 4)))) for _ in range(300)]
    rows += [("", ""), ("", "A"), ("AAAA", "AA"), ("ACACACA", "ACA")]
    return spark.createDataFrame(rows, "s string, p string")


def test_occurrences(seqs):
    for r in seqs.select("s", "p", S.overlapping(F.col("s"), F.col("p")).alias("o"), S.count_apart(F.col("s"), F.col("p")).alias("n")).collect():
        want = [i for i in range(len(r.s)) if r.p and r.s.startswith(r.p, i)]
        assert list(r.o) == want
        assert r.n == (r.s.count(r.p) if r.p else 0)


def test_revcomp_and_slices(seqs):
    for r in seqs.select("s", S.revcomp(S.revcomp(F.col("s"))).alias("rr"), S.slice_seq(F.col("s"), F.lit(3), F.lit(9)).alias("x"), S.slice_seq(F.col("s"), F.lit(-1), F.lit(9)).alias("y")).collect():
        assert r.rr == r.s and r.x == r.s[3:9] and r.y is None


def test_direct_repeats(seqs):
    for r in seqs.select("s", "p", S.direct_repeat_up(F.col("s"), F.col("p")).alias("u"), S.direct_repeat_down(F.col("s"), F.col("p")).alias("d")).collect():
        a, b = r.s[::-1], (r.s + r.p)[::-1]
        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert r.u == (len(r.p) + shared if len(r.p) <= len(r.s) else 0)
        a = r.p + r.s
        assert r.d == next((i for i, (x, y) in enumerate(zip(a, r.s)) if x != y), min(len(a), len(r.s)))


def test_pwm(spark):
    m = [{"A": 0.5, "C": 0.2, "G": 0.2, "T": 0.1}, {"A": 0.1, "C": 0.1, "G": 0.7, "T": 0.1}]
    df = spark.createDataFrame([("AG",), ("TN",), ("A",)], "s string").select(S.pwm_score(F.col("s"), m).alias("x"))
    assert [None if r.x is None else round(r.x, 6) for r in df.collect()] == [100.0, round(100 * 0.1 / 1.2, 6), None]


def naive_blocks(start, cigar, cut, forward):
    out, a, b = [], start, start
    for n, op in re.findall(r"(\d+)(\D)", cigar):
        if op in cut:
            out.append((a, b))
            a = b = b + int(n)
        elif op in forward:
            b += int(n)
    return [*out, (a, b)]


def test_cigar(spark):
    r = random.Random(2)
    rows = [(r.randint(0, 99), "".join(f"{r.randint(1, 50)}{r.choice('MIDNS')}" for _ in range(r.randint(1, 7)))) for _ in range(200)]
    ops = C.parse(F.col("c"))
    df = spark.createDataFrame(rows, "s int, c string").select("s", "c", C.exon_blocks(F.col("s"), ops).alias("e"), C.query_blocks(ops).alias("q"), C.tag_score(ops).alias("t"), C.text(C.reverse(ops)).alias("r"))
    for x in df.collect():
        assert [(b.start, b.end) for b in x.e] == naive_blocks(x.s, x.c, "N", "MD")
        assert [(b.start, b.end) for b in x.q] == naive_blocks(0, x.c, "I", "MD")
        parsed = re.findall(r"(\d+)(\D)", x.c)
        assert x.t == sum(int(n) for n, o in parsed if o in "MI") - sum(o == "D" for _, o in parsed)
        assert x.r == "".join(n + o for n, o in reversed(parsed))


def test_keys(spark):
    df = spark.createDataFrame([("chr1_random_-_5_9", "chr:1+9", "chr2:1,001-2,000"), ("bad", "bad", "bad")], "a string, b string, c string")
    one, two = df.select(K.parse_me(F.col("a")).alias("a"), K.parse_sj(F.col("b")).alias("b"), K.parse_region(F.col("c")).alias("c")).collect()
    assert tuple(one.a) == ("chr1_random", "-", 5, 9) and tuple(one.b) == ("chr", "+", 1, 9) and tuple(one.c) == ("chr2", 1000, 2000)
    assert tuple(two) == (None, None, None)


def test_interval_golden_values(spark):
    assert N.exact_interval(13, 100) == pytest.approx((0.07107391357421874, 0.21204372406005856), abs=1e-12)
    assert N.exact_interval(4, 7) == pytest.approx((0.18405151367187494, 0.9010086059570312), abs=1e-12)
    df = spark.createDataFrame([(4, 7), (8, 5), (0, 0), (None, 3), (0, 4), (4, 4)], "x int, n int").select(N.binomial_interval(F.col("x"), F.col("n")).alias("c"))
    got = [tuple(r.c) for r in df.collect()]
    assert got[1:4] == [(None, None)] * 3 and got[4][0] == 0.0 and got[5][1] == 1.0


def test_beta():
    x = np.linspace(0.01, 0.99, 9)
    assert N.beta_cdf(x, np.full(9, 1.0), np.full(9, 1.0)) == pytest.approx(x, abs=1e-12)
    assert N.beta_cdf(x, np.full(9, 2.0), np.full(9, 1.0)) == pytest.approx(x**2, abs=1e-12)
    assert N.beta_cdf(x, np.full(9, 2.5), np.full(9, 0.7)) == pytest.approx(1 - N.beta_cdf(1 - x, np.full(9, 0.7), np.full(9, 2.5)), abs=1e-12)


def test_mixture(spark):
    r = np.random.default_rng(4)
    x = np.concatenate([r.normal(40, 5, 3000), r.normal(80, 3, 1000)]).round(1)
    fit = N.mixture(spark.createDataFrame([(float(v),) for v in x], "u2 double"), "u2").first()
    assert fit.m1 == pytest.approx(40, abs=1) and fit.m2 == pytest.approx(80, abs=1) and fit.w == pytest.approx(0.75, abs=0.02)
    assert N.mixture(spark.createDataFrame([], "u2 double"), "u2").collect() == []


def test_beta_distribution_of_large_counts():
    """Against exact sums of binomial terms in whole numbers, and closed forms."""
    from fractions import Fraction
    from math import comb

    for a, b in [(3, 9), (150, 250), (201, 220), (400, 1_500)]:
        n = a + b - 1
        for k in (-4, -1, 0, 0.5, 3):
            x = Fraction(round((a / (a + b) + k * (a * b / (a + b) ** 3) ** 0.5) * 4096), 4096)
            if 0 < x < 1:
                tail = sum(comb(n, j) * x**j * (1 - x) ** (n - j) for j in range(a, n + 1))
                assert float(N.beta_cdf(np.array([float(x)]), np.array([a]), np.array([b]))[0]) == pytest.approx(float(tail), abs=1e-11)
    big = np.array([1e3, 1e5, 1e7, 1e9])
    assert N.beta_cdf(np.full(4, 0.5), big, big) == pytest.approx(0.5, abs=1e-10)
    x = np.array([1e-12, 1e-9, 5e-9, 3e-8])
    assert N.beta_cdf(x, np.ones(4), np.full(4, 1e9)) == pytest.approx(-np.expm1(1e9 * np.log1p(-x)), abs=1e-9)
    both = N.beta_cdf(np.array([0.3001, 0.2999]), np.full(2, 3e7), np.full(2, 7e7))
    assert both[0] == pytest.approx(1 - N.beta_cdf(np.array([0.6999]), np.array([7e7]), np.array([3e7]))[0], abs=1e-10) and both[1] < 0.5 < both[0]
    assert np.isnan(N.beta_cdf(np.array([0.5, np.nan]), np.array([0.0, 1.0]), np.array([1.0, 1.0]))).all()
