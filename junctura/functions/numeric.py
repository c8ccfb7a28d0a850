"""Numerics that Spark SQL lacks, vectorised over Arrow batches: binomial intervals, Beta distribution, a two-component mixture."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import written

_WIDTH, _TAIL = 1e-5, 0.025


def exact_intervals(x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The exact 95 % intervals of proportions x of n, by bisection to 1e-5 on the binomial tails, all at once."""
    x, n = np.asarray(x, float), np.asarray(n, float)

    def bisect(a, b, above):
        v = (a + b) / 2
        for _ in range(17):  # halves 1 to below 1e-5
            going = b - a > _WIDTH
            up = above(v)
            b, a = np.where(going & up, v, b), np.where(going & ~up, v, a)
            v = np.where(going, (a + b) / 2, v)
        return v

    share = x / n
    # P(X >= x) and P(X <= x) of n trials are incomplete beta functions of the chance
    lo = bisect(np.zeros_like(share), share, lambda p: beta_cdf(p, np.maximum(x, 1), n - x + 1) > _TAIL)
    hi = bisect(share, np.ones_like(share), lambda p: beta_cdf(1 - p, np.maximum(n - x, 1), x + 1) < _TAIL)
    return np.where(x == 0, 0.0, lo), np.where(x == n, 1.0, hi)


def exact_interval(x: int, n: int) -> tuple[float, float]:
    lo, hi = exact_intervals(np.array([x]), np.array([n]))
    return float(lo[0]), float(hi[0])


@F.pandas_udf(T.StructType().add("lo", "double").add("hi", "double"))
def _interval(x: pd.Series, n: pd.Series) -> pd.DataFrame:
    ok = (x.notna() & n.notna() & (x >= 0) & (x <= n) & (n > 0)).to_numpy()
    out = np.full((len(x), 2), np.nan)
    pairs, place = np.unique(np.stack([x[ok].to_numpy(np.int64), n[ok].to_numpy(np.int64)]), axis=1, return_inverse=True)
    if pairs.shape[1]:
        out[ok] = np.stack(exact_intervals(*pairs), axis=1)[place.reshape(-1)]
    return pd.DataFrame(out, columns=["lo", "hi"])


def binomial_interval(x: Column, n: Column) -> Column:
    """Struct (lo, hi); null for n = 0 and where x is not within 0..n."""
    got = _interval(x.cast("long"), n.cast("long"))
    null = F.lit(None).cast("double")
    return F.struct(F.nanvl(got["lo"], null).alias("lo"), F.nanvl(got["hi"], null).alias("hi"))


#: Coefficients of Stirling's series of log gamma: Bernoulli numbers by 2k(2k - 1).
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156)
#: Above this both ways are exact; the fraction is the slower.
_LARGE = 200
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(64)


def _excess(x: np.ndarray) -> np.ndarray:
    """log gamma(x) less Stirling's (x - 1/2) log x - x + log(2 pi) / 2, for x > 0; small numbers are raised to 10 and above by the recurrence."""
    low = x < 10
    n = np.where(low, np.ceil(10 - x), 0)
    y = x + n
    out, power = np.zeros_like(y), 1 / y
    for c in _STIRLING:
        out = out + c * power
        power = power / (y * y)
    if low.any():
        # gamma(x) = gamma(x + n) / (x (x + 1) ... (x + n - 1))
        steps = np.where(np.arange(11)[:, None] < n, np.log(x + np.arange(11)[:, None]), 0.0).sum(axis=0)
        out = np.where(low, out + (y - 0.5) * np.log(y) - y - steps - (x - 0.5) * np.log(x) + x, out)
    return out


def _front(z: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """z**p y**q / B(p, q) with y = 1 - z, without the difference of large logarithms: deviance terms and the excesses of log gamma."""
    n = p + q
    off = np.where(z > 0.5, q - n * y, n * z - p)
    # p log(z n / p) + q log((1 - z) n / q) loses nothing where z is near p / n
    deviance = p * np.log1p(off / p) + q * np.log1p(-off / q)
    return np.exp(deviance + _excess(n) - _excess(p) - _excess(q)) * np.sqrt(p * q / n / (2 * np.pi))


def _by_fraction(z: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The incomplete beta function by its continued fraction, which is fast where z is not far above p / (p + q) or p is small."""
    tiny = 1e-300
    c, d = np.ones_like(z), 1 - (p + q) * z / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 20_000):
        for t in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d, c = 1 + t * d, 1 + t / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.isnan(h) | (np.abs(d * c - 1) < 1e-14)):
            break
    else:
        raise RuntimeError("the continued fraction did not converge")
    front = _front(z, y, p, q)
    return np.where(front == 0, 0.0, front / p * h)


def _by_quadrature(z: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The same for large p and q, where the fraction is slow: 64 Gauss points over the 12 standard deviations below z that hold what there is."""
    n = p + q
    sd = np.sqrt(p * q / n) / n
    low = np.maximum(np.minimum(z - 12 * sd, p / n - 12 * sd), 0)
    # far below the mean the mass lies within few of its decay lengths under z
    decay = 1 / np.maximum(np.abs(p / np.maximum(z, 1e-300) - q / np.maximum(1 - z, 1e-300)), 1 / sd)
    low = np.maximum(low, z - 45 * np.maximum(decay, 0.3 * sd))
    half = (z - low) / 2
    out = np.zeros_like(z)
    for x, w in zip(_NODES, _WEIGHTS, strict=True):
        back = half * (1 - x)
        inside = z > back
        s, rest = np.where(inside, z - back, 0.5), np.where(inside, y + back, 0.5)
        out = out + np.where(inside, w * _front(s, rest, p, q) / (s * rest), 0.0)
    return out * half


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function for whole arrays, to 1e-9 for parameters from 1 to 1e9."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, float) for v in (x, a, b)))
    shape = x.shape
    x, a, b = x.ravel(), a.ravel(), b.ravel()
    # the complement of a small x loses digits, which matter up to some deviations above the mean
    sd = np.sqrt(a * b / (a + b)) / (a + b)
    swap = x > a / (a + b) + np.where((x > 0.05) | (np.minimum(a, b) > _LARGE), 0, 3 * sd)
    p, q, z, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x), np.where(swap, x, 1 - x)
    half = np.full(len(x), np.nan)
    with np.errstate(all="ignore"):
        inner = (x > 0) & (x < 1) & (a > 0) & (b > 0)
        for part, way in ((inner & (np.minimum(p, q) <= _LARGE), _by_fraction), (inner & (np.minimum(p, q) > _LARGE), _by_quadrature)):
            if part.any():
                half[part] = way(z[part], y[part], p[part], q[part])
    out = np.where(swap, 1 - half, half)
    out = np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, np.clip(out, 0, 1)))
    return np.where(np.isnan(x) | ~((a > 0) & (b > 0)), np.nan, out).reshape(shape)


@F.pandas_udf(T.DoubleType())
def _beta(x: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    ok = (a > 0) & (b > 0) & x.notna()
    out = pd.Series(np.nan, index=x.index)
    out[ok] = beta_cdf(x[ok], a[ok], b[ok])
    return out.astype(object).where(ok, None).astype("float64")


def beta_probability(x: Column, mean: Column, var: Column) -> Column:
    """P(X <= x) of the Beta distribution with this mean and variance; null where none has them."""
    k = F.when((var > 0) & (mean > 0) & (mean < 1), mean * (1 - mean) / var - 1)
    return F.nanvl(_beta(x.cast("double"), (mean * k).cast("double"), ((1 - mean) * k).cast("double")), F.lit(None).cast("double"))


def mixture(scores: DataFrame, score: str, rounds: int = 200) -> DataFrame:
    """Two normal components of a score by EM from a fixed start (the lower and upper half): one row (w, m1, s1, m2, s2), m1 <= m2.

    Each round is an aggregation over distinct scores with their counts, so data stay distributed; five numbers go round.  Ends early once none moves by 1e-9.
    """
    table = written(scores.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("x")).agg(F.count("*").alias("n")), "scores")
    s = table.agg(F.percentile("x", 0.5, F.col("n")).alias("mid"), F.sum("n").alias("n")).first()
    spark = scores.sparkSession
    kind = "w double, m1 double, s1 double, m2 double, s2 double"
    if not s["n"]:
        return spark.createDataFrame([], kind)
    r = table.agg(*(F.sum(F.when(c, F.col("n") * f)).alias(f"{a}{i}") for i, c in ((1, F.col("x") <= s["mid"]), (2, F.col("x") > s["mid"])) for a, f in (("n", F.lit(1)), ("s", F.col("x")), ("q", F.col("x") * F.col("x"))))).first()

    def moments(n, t, q):
        m = t / n
        return n, m, math.sqrt(max(q / n - m * m, 1e-12))

    if not r["n2"]:
        return spark.createDataFrame([(1.0, s["mid"], 1e-6, s["mid"], 1e-6)], kind)
    (n1, m1, s1), (n2, m2, s2) = moments(r["n1"], r["s1"], r["q1"]), moments(r["n2"], r["s2"], r["q2"])
    w = n1 / (n1 + n2)
    for _ in range(rounds):
        density = lambda m, d: F.exp(-F.pow((F.col("x") - m) / d, F.lit(2.0)) / 2) / d
        a, b = w * density(m1, s1), (1 - w) * density(m2, s2)
        weighed = table.withColumn("p", F.coalesce(F.try_divide(a, a + b), F.lit(0.5)) * F.col("n"))
        r = weighed.agg(F.sum("p"), F.sum(F.col("p") * F.col("x")), F.sum(F.col("p") * F.col("x") * F.col("x")), F.sum(F.col("n") - F.col("p")), F.sum((F.col("n") - F.col("p")) * F.col("x")), F.sum((F.col("n") - F.col("p")) * F.col("x") * F.col("x"))).first()
        if r[0] < 1e-9 or r[3] < 1e-9:
            break
        (n1, a1, b1), (n2, a2, b2) = moments(*r[:3]), moments(*r[3:])
        moved = max(abs(a1 - m1), abs(b1 - s1), abs(a2 - m2), abs(b2 - s2))
        m1, s1, m2, s2, w = a1, b1, a2, b2, n1 / (n1 + n2)
        if moved < 1e-9:
            break
    if m1 > m2:
        w, m1, s1, m2, s2 = 1 - w, m2, s2, m1, s1
    return spark.createDataFrame([(w, m1, s1, m2, s2)], kind)


def posterior(x: Column, w: float, m1: float, s1: float, m2: float, s2: float) -> Column:
    """Chance that a score is of the lower component."""
    density = lambda m, d: F.exp(-F.pow((x - m) / d, F.lit(2.0)) / 2) / d
    a, b = w * density(m1, s1), (1 - w) * density(m2, s2)
    return F.try_divide(a, a + b)


def p_value(post: Column, p_me: Column, n_matches: Column) -> Column:
    """``1 - (1 - post * P_ME) / n_matches``."""
    return 1 - F.try_divide(1 - post * p_me, n_matches)
