"""Queries on coverage, inclusion, filters, isoforms, nodes, pools and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import numeric as N
from ..functions import sequence as S
from ..operators import annotation as A
from ..operators import coverage as Q
from ..operators import differential as D
from ..operators import discovery as X
from ..operators import filters as L
from ..operators import intervals as I
from ..operators import isoforms as G
from ..operators import regions as R
from ..operators.dealing import dealt
from ..sources.shared import written
from .registry import exon_parts, query, table, v_align, v_cell, v_cov, v_dna, v_exon, v_node
from .sequences import _CUT


def long(c: str):
    return F.col(c).cast("long").alias(c)


# coverage and inclusion -----------------------------------------------------------------------------------------------------------------

_CI = """list_reduce(range(0, 24), lambda s, i: CASE WHEN s.h - s.l <= 1e-5 THEN s WHEN list_sum(list_transform(range({a}, {b}), lambda k:
  exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(s.v) + (n - k) * ln(1 - s.v)))) {op} 0.025 THEN {{'l': s.l, 'h': s.v, 'v': (s.l + s.v) / 2}} ELSE {{'l': s.v, 'h': s.h, 'v': (s.v + s.h) / 2}} END,
  {{'l': {lo}, 'h': {hi}, 'v': {mid}}}).v"""
_LO = "CASE WHEN x = 0 THEN 0.0 ELSE " + _CI.format(a="CAST(x AS BIGINT)", b="CAST(n AS BIGINT) + 1", op=">", lo="0.0::DOUBLE", hi="x / n", mid="x / n / 2") + " END"
_HI = "CASE WHEN x = n THEN 1.0 ELSE " + _CI.format(a="0", b="CAST(x AS BIGINT) + 1", op="<", lo="x / n", hi="1.0::DOUBLE", mid="(1 + x / n) / 2") + " END"


@query("SELECT sample, me, inc, skip, CASE WHEN inc + skip >= 3 THEN round(inc / (inc + skip), 9) END AS psi FROM v_cov", "v_cov")
def p29_psi(spark, sf):
    return Q.psi(v_cov(spark, sf), 3).select("sample", "me", "inc", "skip", F.round("psi", 9).alias("psi"))


@query(f"WITH p AS (SELECT DISTINCT CAST(inc AS DOUBLE) AS x, CAST(inc + skip AS DOUBLE) AS n FROM v_cov) SELECT CAST(x AS BIGINT) AS x, CAST(n AS BIGINT) AS n, round({_LO}, 6) AS lo, round({_HI}, 6) AS hi FROM p", "v_cov")
def p30_ci(spark, sf):
    d = v_cov(spark, sf).select(F.col("inc").alias("x"), (F.col("inc") + F.col("skip")).alias("n")).distinct().withColumn("ci", N.binomial_interval(F.col("x"), F.col("n")))
    return d.select("x", "n", F.round("ci.lo", 6).alias("lo"), F.round("ci.hi", 6).alias("hi"))


@query("SELECT CASE WHEN sample % 2 = 1 THEN sample - 1 ELSE sample END AS sample, me, CAST(sum(inc) AS BIGINT) AS inc, CAST(sum(skip) AS BIGINT) AS skip FROM v_cov GROUP BY 1, 2", "v_cov")
def a30_paired_psi(spark, sf):
    cov = v_cov(spark, sf)
    pairs = cov.where("sample % 2 = 1").select((F.col("sample") - 1).alias("pair1"), F.col("sample").alias("pair2")).distinct()
    return Q.pair_samples(cov, pairs)


_ALT = """SELECT tx, block, CASE WHEN block % 2 = 0 THEN 'alt5' ELSE 'alt3' END AS kind, strand, "start", "end", len % 9 AS inc, len % 5 AS skip, tx % 4 AS total5, tx % 3 AS total3, len % 4 AS cov FROM v_exon"""


@query(
    f"""SELECT tx, CAST(block AS BIGINT) AS block, kind, CASE WHEN n >= 5 THEN round(cov / n, 9) END AS alt_psi, CAST(CASE WHEN lft THEN "start" - 19 ELSE "end" + 1 END AS BIGINT) AS "from", CAST(CASE WHEN lft THEN "start" ELSE "end" + 30 END AS BIGINT) AS "to"
FROM (SELECT *, 2 * inc + skip + total5 + total3 AS n, (kind = 'alt5' AND strand = '+') OR (kind = 'alt3' AND strand = '-') AS lft FROM ({_ALT}))""",
    "v_exon",
)
def p31_alt_psi(spark, sf):
    d = v_exon(spark, sf).select("tx", "block", F.when(F.col("block") % 2 == 0, "alt5").otherwise("alt3").alias("kind"), "strand", "start", "end", (F.col("len") % 9).alias("inc"), (F.col("len") % 5).alias("skip"), (F.col("tx") % 4).alias("total5"), (F.col("tx") % 3).alias("total3"), (F.col("len") % 4).alias("cov"))
    d = d.withColumns({"alt_start": F.col("start") - 20, "alt_end": F.col("end") + 30})
    return Q.alternative_psi(d, 5).select("tx", long("block"), "kind", F.round("alt_psi", 9).alias("alt_psi"), long("from"), long("to"))


@query(
    """WITH c AS (SELECT CAST(tag AS VARCHAR) AS tag, count(*) AS reads FROM v_align GROUP BY tag), m AS (SELECT DISTINCT supp AS me, CAST(tag AS VARCHAR) AS sj, CAST(tag + 1 AS VARCHAR) AS me_tag FROM v_align)
SELECT me, string_agg(m.sj, ',' ORDER BY m.sj) AS total_sjs, string_agg(CAST(coalesce(b.reads, 0) AS VARCHAR), ',' ORDER BY m.sj) AS me_coverages, CAST(sum(coalesce(b.reads, 0)) AS BIGINT) AS sum_me,
  string_agg(CAST(coalesce(a.reads, 0) AS VARCHAR), ',' ORDER BY m.sj) AS sj_coverages, CAST(sum(coalesce(a.reads, 0)) AS BIGINT) AS sum_sj FROM m LEFT JOIN c a ON a.tag = m.sj LEFT JOIN c b ON b.tag = m.me_tag GROUP BY me""",
    "v_align",
)
def a11_me_sums(spark, sf):
    d = v_align(spark, sf)
    counts = d.groupBy(F.col("tag").cast("string").alias("tag")).agg(F.count("*").alias("reads"))
    mes = d.select(F.col("supp").alias("me"), F.col("tag").cast("string").alias("sj"), (F.col("tag") + 1).cast("string").alias("me_tag")).distinct()
    return Q.me_sums(mes, counts)


_BOUND = """m AS (SELECT DISTINCT chrom || '_' || strand || '_' || "start" || '_' || "end" AS me, chrom, strand, "start" AS s, "end" AS e FROM v_exon WHERE "end" - "start" <= 12),
x AS (SELECT DISTINCT chrom, strand, "start" AS xs, "end" AS xe FROM v_exon v WHERE "end" - "start" > 12 AND EXISTS (SELECT 1 FROM v_exon z WHERE z.tx = v.tx AND z."start" > v."start")), g AS (SELECT chrom, "start" AS gs, "end" AS ge, count(*) AS n FROM v_intron GROUP BY ALL),
b AS (SELECT DISTINCT m.me, m.chrom, x.xs, x.xe, k.kind FROM m JOIN x ON x.chrom = m.chrom, (VALUES ('alt3'), ('alt5')) k(kind) WHERE CASE WHEN (kind = 'alt3') = (m.strand = '+') THEN s ELSE e END = CASE WHEN (kind = 'alt3') = (x.strand = '+') THEN xs ELSE xe END),
h AS (SELECT me, kind, xs, xe, 'L|' || xs || '|' || gs AS i, n FROM b JOIN g ON g.chrom = b.chrom AND g.ge = xs UNION ALL SELECT me, kind, xs, xe, 'R|' || xe || '|' || ge, n FROM b JOIN g ON g.chrom = b.chrom AND g.gs = xe)"""


def _short(e: DataFrame, parts: int) -> DataFrame:
    """The exons of at most 12 bases, each once, as microexons."""
    place = ["chrom", "strand", "start", "end"]
    return dealt(e.where("end - start <= 12").select(*place), parts, *place).distinct().select(K.me_id(*map(F.col, place)).alias("me"), *place)


def _intron_counts(e: DataFrame, parts: int) -> DataFrame:
    place = ["chrom", "start", "end"]
    return dealt(A.introns(e).select(*place), parts, *place).groupBy(*place).agg(F.count("*").alias("n"))


@query(
    f"""WITH {_BOUND}, c AS (SELECT b.me, b.kind, b.xs, b.xe, CAST(coalesce(sum(n), 0) AS BIGINT) AS cov FROM b LEFT JOIN h USING (me, kind, xs, xe) GROUP BY ALL), t AS (SELECT me, kind, CAST(sum(n) AS BIGINT) AS total FROM (SELECT DISTINCT me, kind, i, n FROM h) GROUP BY ALL)
SELECT c.me, c.kind, string_agg(xs || ':' || xe || ':' || cov, ',' ORDER BY xs, xe, cov) AS exons, coalesce(any_value(total), 0) AS total FROM c LEFT JOIN t USING (me, kind) GROUP BY c.me, c.kind""",
    "v_intron",
)
def a12_alt_cov(spark, sf):
    e, parts = v_exon(spark, sf), exon_parts(spark, sf)
    return Q.alternative_exons(_short(e, parts), e, _intron_counts(e, parts), 12, parts)


@query("SELECT me, count(*) FILTER (WHERE inc >= 2) AS n_samples FROM v_cov GROUP BY me", "v_cov")
def a13_sample_filter(spark, sf):
    return Q.samples_passing(v_cov(spark, sf), 2)


@query("SELECT sample, me FROM v_cov WHERE inc >= 2", "v_cov")
def f16_sample_pass(spark, sf):
    return v_cov(spark, sf).where("inc >= 2").select("sample", "me")


@query("SELECT me, CAST(sum(inc) AS BIGINT) AS up, CAST(sum(skip) AS BIGINT) AS down FROM v_cov GROUP BY me", "v_cov")
def a14_updown(spark, sf):
    return L.up_down_totals(v_cov(spark, sf).withColumnsRenamed({"inc": "up", "skip": "down"}))


@query("SELECT me, CASE WHEN sum(inc + skip) > 0 THEN round(abs(sum(inc) - sum(skip)) / sum(inc + skip), 9) END AS balance FROM v_cov GROUP BY me", "v_cov")
def p37_balance(spark, sf):
    d = L.up_down_totals(v_cov(spark, sf).withColumnsRenamed({"inc": "up", "skip": "down"})).withColumns({"share": F.lit(2), "in_intron_end": F.lit(False)})
    return L.route(d).select("me", F.round("balance", 9).alias("balance"))


_ME = """m AS (SELECT DISTINCT chrom || '_' || strand || '_' || "start" || '_' || "end" AS me, chrom, strand, "start" AS s, "end" AS e FROM v_exon)"""


@query(f"WITH {_ME} SELECT me, count(DISTINCT me) OVER (PARTITION BY chrom, strand, s) + count(DISTINCT me) OVER (PARTITION BY chrom, strand, e) AS share FROM m", "v_exon")
def a15_shared_boundaries(spark, sf):
    return L.shared_boundaries(v_exon(spark, sf).withColumn("me", K.me_id(F.col("chrom"), F.col("strand"), F.col("start"), F.col("end"))))


@query(
    f"""WITH {_ME}, s AS (SELECT me, e - s AS len, count(*) OVER (PARTITION BY chrom, strand, s) + count(*) OVER (PARTITION BY chrom, strand, e) AS share FROM m), b AS (SELECT *, len % 7 AS up, len % 11 % 3 AS down FROM s)
SELECT me, CASE WHEN up + down = 0 THEN NULL WHEN share > 2 AND abs(up - down) / (up + down) > 0.95 THEN 'drop' WHEN len % 4 = 0 THEN 'ambiguous' ELSE 'high' END AS route FROM b""",
    "v_exon",
)
def f15_route(spark, sf):
    d = v_exon(spark, sf).withColumn("me", K.me_id(F.col("chrom"), F.col("strand"), F.col("start"), F.col("end")))
    rows = d.select("me", (F.col("end") - F.col("start")).alias("n")).distinct().join(L.shared_boundaries(d), "me")
    rows = rows.withColumns({"up": F.col("n") % 7, "down": F.col("n") % 11 % 3, "in_intron_end": F.col("n") % 4 == 0})
    return L.route(rows).select("me", "route")


@query("SELECT sample, me, round(inc / (inc + skip), 9) AS psi FROM v_cov WHERE inc / (inc + skip) > 0.3 AND inc + skip > 0", "v_cov")
def f18_high_psi(spark, sf):
    return Q.psi(v_cov(spark, sf), 1).where("psi > 0.3").select("sample", "me", F.round("psi", 9).alias("psi"))


@query("SELECT sample, me || '|' || inc || '|' || skip AS total, me AS m, CAST(inc AS DOUBLE) AS u2, CAST(skip AS DOUBLE) AS cons FROM v_cov", "v_cov")
def p28_explode_matches(spark, sf):
    d = v_cov(spark, sf).groupBy("sample").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("|", "me", F.col("inc").cast("string"), F.col("skip").cast("string")))), ",").alias("total_me"))
    out = L.explode_matches(d)
    return out.select("sample", F.concat_ws("|", "me", F.col("u2").cast("long").cast("string"), F.col("cons").cast("long").cast("string")).alias("total"), F.col("me").alias("m"), "u2", "cons")


@query("SELECT me, count(*) AS rows, max(CAST(me AS BIGINT)) < 3 AS short FROM v_cov WHERE me IN (SELECT me FROM v_cov GROUP BY me HAVING count(*) FILTER (WHERE inc >= 1) >= 20) GROUP BY me", "v_cov")
def f13_detect_split(spark, sf):
    cov = v_cov(spark, sf)
    d = L.detected(cov.withColumn("len", F.col("me").cast("long")), Q.samples_passing(cov, 1), 20)
    return d.groupBy("me").agg(F.count("*").alias("rows"), F.max("short").alias("short"))


@query("SELECT sample, me, CASE WHEN p <= 0.3 THEN 'IN' WHEN skip >= 3 THEN 'RESCUED' ELSE 'OUT' END AS me_type FROM (SELECT *, inc / (inc + skip) AS p FROM v_cov)", "v_cov")
def f14_class(spark, sf):
    d = Q.psi(v_cov(spark, sf), 1)
    return d.select("sample", "me", L.classify(F.col("psi"), 0.3, F.col("skip"), 3).alias("me_type"))


_PV = "p AS (SELECT p_size AS len, (p_retailprice - floor(p_retailprice / 10) * 10) / 10 AS p FROM part)"
_HIST = "h AS (SELECT CAST(round(0.1 + i * 0.01, 2) AS DOUBLE) AS threshold, CAST(len AS BIGINT) AS len, count(*) AS n FROM (SELECT len, greatest(CAST(ceil(round((p - 0.1) / 0.01, 6)) AS INTEGER), 0) AS first FROM p), range(0, 91) t(i) WHERE first <= i GROUP BY i, len)"


def _hist(spark, sf) -> DataFrame:
    price = F.col("p_retailprice")
    d = table(spark, sf, "part").select(F.col("p_size").cast("long").alias("len"), ((price - F.floor(price / 10) * 10) / 10).alias("p"))
    return L.length_histogram(d)


@query(f"WITH {_PV}, {_HIST} SELECT * FROM h")
def a21_threshold_hist(spark, sf):
    return _hist(spark, sf)


_SIGMA = "s AS (SELECT threshold, count(sigma) AS k, sum(sigma) AS sigma FROM (SELECT threshold, CASE WHEN count(*) >= 3 AND regr_sxx(n, len) > 0 THEN sqrt(greatest(regr_syy(n, len) - regr_sxy(n, len) * regr_sxy(n, len) / regr_sxx(n, len), 0) / (count(*) - 2)) END AS sigma FROM h GROUP BY threshold, len % 3 = 0) GROUP BY threshold)"


@query(f"WITH {_PV}, {_HIST}, {_SIGMA} SELECT threshold, CASE WHEN k = 2 THEN round(sigma, 5) END AS sigma FROM s")
def a22_ols_sigma(spark, sf):
    return L.residual_sigma(_hist(spark, sf)).select("threshold", F.round("sigma", 5).alias("sigma"))


@query(f"WITH {_PV}, {_HIST}, {_SIGMA} SELECT arg_min(threshold, sigma) AS threshold, round(min(sigma), 5) AS sigma FROM s WHERE k = 2")
def a22_best_threshold(spark, sf):
    return L.best_threshold(L.residual_sigma(_hist(spark, sf))).select("threshold", F.round("sigma", 5).alias("sigma"))


@query(f"WITH {_PV}, {_HIST}, z AS (SELECT threshold, len, (n - avg(n) OVER w) / nullif(stddev_samp(n) OVER w, 0) AS z FROM h WINDOW w AS (PARTITION BY threshold)) SELECT threshold, round(sum(z) FILTER (WHERE len BETWEEN 3 AND 5), 6) + 0.0 AS short_z, round(sum(z) FILTER (WHERE len >= 6), 6) + 0.0 AS long_z FROM z GROUP BY threshold")
def a23_zscore_threshold(spark, sf):
    return L.zscore_threshold(_hist(spark, sf)).select("threshold", (F.round("short_z", 6) + 0.0).alias("short_z"), (F.round("long_z", 6) + 0.0).alias("long_z"))


@query("SELECT me, CAST(sum(inc) AS BIGINT) AS n1, CAST(sum(skip) AS BIGINT) AS n2, CASE WHEN sum(inc) > 0 AND sum(skip) > 0 THEN round(log2(sum(skip) / sum(inc)), 9) END AS log2_ratio FROM v_cov GROUP BY me", "v_cov")
def a24_log2_ratio(spark, sf):
    cov = v_cov(spark, sf)
    d = L.log_ratio(cov.select("me", F.col("inc").alias("n")), cov.select("me", F.col("skip").alias("n")))
    return d.select("me", "n1", "n2", F.round("log2_ratio", 9).alias("log2_ratio"))


def _dense_sql(m: str, s: str) -> str:
    return f"exp(-pow((x - {m}) / {s}, 2.0) / 2) / {s}"


_EM = f"""WITH RECURSIVE t AS (SELECT CAST(round(p_retailprice, 0) AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS n FROM part GROUP BY 1),
half AS (SELECT median(round(p_retailprice, 0)) AS mid FROM part), h AS (SELECT x <= mid AS low, sum(n) AS n, sum(n * x) / sum(n) AS m, sum(n * x * x) / sum(n) AS q FROM t, half GROUP BY 1),
em AS (SELECT 0 AS i, a.n / (a.n + b.n) AS w, a.m AS m1, sqrt(greatest(a.q - a.m * a.m, 1e-12)) AS s1, b.m AS m2, sqrt(greatest(b.q - b.m * b.m, 1e-12)) AS s2 FROM h a, h b WHERE a.low AND NOT b.low
UNION ALL SELECT i + 1, p / (p + q), p1 / p, sqrt(greatest(p2 / p - (p1 / p) * (p1 / p), 1e-12)), q1 / q, sqrt(greatest(q2 / q - (q1 / q) * (q1 / q), 1e-12))
  FROM (SELECT i, sum(r) AS p, sum(r * x) AS p1, sum(r * x * x) AS p2, sum(n - r) AS q, sum((n - r) * x) AS q1, sum((n - r) * x * x) AS q2
    FROM (SELECT i, x, n, n * w * {_dense_sql('m1', 's1')} / (w * {_dense_sql('m1', 's1')} + (1 - w) * {_dense_sql('m2', 's2')}) AS r FROM em, t WHERE i < 60) GROUP BY i))
SELECT round(CASE WHEN m1 <= m2 THEN w ELSE 1 - w END, 5) AS w, round(least(m1, m2), 3) AS m1, round(CASE WHEN m1 <= m2 THEN s1 ELSE s2 END, 3) AS s1, round(greatest(m1, m2), 3) AS m2, round(CASE WHEN m1 <= m2 THEN s2 ELSE s1 END, 3) AS s2 FROM em WHERE i = 60"""


@query(_EM)
def a20_em2(spark, sf):
    fit = N.mixture(table(spark, sf, "part").select(F.round("p_retailprice", 0).alias("u2")), "u2", 60)
    return fit.select(F.round("w", 5).alias("w"), *(F.round(c, 3).alias(c) for c in ("m1", "s1", "m2", "s2")))


_FIT = (0.4, 40.0, 15.0, 75.0, 10.0)
_DENSE = "exp(-pow((psi * 100 - {m}) / {s}, 2.0) / 2) / {s}"
_POST = f"({_FIT[0]} * {_DENSE.format(m=_FIT[1], s=_FIT[2])}) / ({_FIT[0]} * {_DENSE.format(m=_FIT[1], s=_FIT[2])} + {1 - _FIT[0]} * {_DENSE.format(m=_FIT[3], s=_FIT[4])})"


@query(f"SELECT node, round(1 - (1 - {_POST} * 0.25) / (1 + node % 4), 9) AS p FROM v_node", "v_node")
def p35_pvalue(spark, sf):
    d = v_node(spark, sf)
    return d.select("node", F.round(N.p_value(N.posterior(F.col("psi") * 100, *_FIT), F.lit(0.25), 1 + F.col("node") % 4), 9).alias("p"))


@query("SELECT user_id AS sample, event_type, count(*) AS n FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10) GROUP BY ALL")
def j4_semi(spark, sf):
    c = table(spark, sf, "customer").where("c_nationkey < 10").select(F.col("c_custkey").alias("user_id"))
    return table(spark, sf, "events").join(c, "user_id", "left_semi").groupBy(F.col("user_id").alias("sample"), "event_type").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def j5_anti(spark, sf):
    o = table(spark, sf, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(o, "c_custkey", "left_anti").select("c_custkey")


@query("WITH t AS (SELECT DISTINCT chrom, strand, \"start\" AS s, \"end\" AS e FROM v_exon WHERE \"end\" - \"start\" <= 15) SELECT chrom, strand, CAST(s AS BIGINT) AS \"start\", CAST(e AS BIGINT) AS \"end\" FROM t WHERE NOT EXISTS (SELECT 1 FROM v_intron i WHERE i.chrom = t.chrom AND i.strand = t.strand AND i.\"start\" = t.s)", "v_intron")
def j8_annot_anti(spark, sf):
    e, parts, at = v_exon(spark, sf), exon_parts(spark, sf), ["chrom", "strand", "start"]
    # dealt by start once, to be told apart and to meet the introns
    gaps = A.introns(e).select(*at)
    short = dealt(e.where("end - start <= 15").select(*at, "end"), parts, *at).distinct()
    return short.join(gaps, at, "left_anti").select("chrom", "strand", long("start"), long("end"))


@query('SELECT i.tx, CAST(i.block AS BIGINT) AS block, count(*) AS n, CAST(sum(e."start") AS BIGINT) AS places FROM v_intron i JOIN (SELECT DISTINCT chrom, strand, "start", "end" FROM v_exon WHERE "end" - "start" <= 10) e ON e.chrom = i.chrom AND e.strand = i.strand AND i."start" <= e."start" AND e."end" <= i."end" GROUP BY ALL', "v_intron")
def j9_containment(spark, sf):
    e = v_exon(spark, sf)
    inner = e.where("end - start <= 10").select("chrom", "strand", F.col("start").alias("in_start"), F.col("end").alias("in_end")).distinct()
    hit = I.contains(A.introns(e), inner, ["chrom", "strand"], 128)
    return hit.groupBy("tx", long("block")).agg(F.count("*").alias("n"), F.sum("in_start").alias("places"))


@query(
    """WITH v AS (SELECT DISTINCT chrom, "start" AS rs, "end" AS re, "start" % 10 AS value FROM v_exon), r AS (SELECT DISTINCT chrom, "start" - 2 AS s, "end" + 2 AS e, "start" AS a, "end" AS b FROM v_exon WHERE "end" - "start" <= 10),
h AS (SELECT r.chrom, a, b, sum(value * (least(e, re) - greatest(s, rs))) / sum(least(e, re) - greatest(s, rs)) AS mean FROM r JOIN v ON v.chrom = r.chrom AND s < re AND rs < e GROUP BY ALL)
SELECT r.chrom, CAST(r.a AS BIGINT) AS "start", CAST(r.b AS BIGINT) AS "end", CAST(floor(mean * 1000) AS BIGINT) AS mean FROM r LEFT JOIN h USING (chrom, a, b)""",
    "v_exon",
)
def j26_range_mean(spark, sf):
    e = v_exon(spark, sf)
    values = e.select("chrom", "start", "end", (F.col("start") % 10).alias("value")).distinct()
    mes = e.where("end - start <= 10").select("chrom", "start", "end").distinct().withColumn("me", F.concat_ws("_", "chrom", "start", "end"))
    out = I.mean_value(mes, values, ["me"]).join(mes, "me")
    return out.select("chrom", long("start"), long("end"), F.floor(F.col("mean") * 1000).cast("long").alias("mean"))


@query("SELECT c.c_custkey, coalesce(o.n, 0) AS n FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey")
def j16_left_default(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return table(spark, sf, "customer").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    """WITH k AS (SELECT gene, CAST(p_size AS DOUBLE) AS x, avg(psi) AS y FROM v_node JOIN part ON p_partkey = node WHERE type = 'AA' GROUP BY ALL), q AS (SELECT gene, node, psi * 50 AS x FROM v_node WHERE type <> 'AA'),
lo AS (SELECT q.*, k.x AS x0, k.y AS y0 FROM q ASOF LEFT JOIN k ON k.gene = q.gene AND q.x >= k.x)
SELECT lo.gene, lo.node, round(CASE WHEN x0 IS NULL OR k.x IS NULL THEN NULL WHEN k.x = x0 THEN y0 ELSE y0 + (k.y - y0) * (lo.x - x0) / (k.x - x0) END, 9) AS y FROM lo ASOF LEFT JOIN k ON k.gene = lo.gene AND lo.x <= k.x""",
    "v_node",
)
def j15_interpolate(spark, sf):
    """Linear interpolation between known points; equal places are averaged, and beyond the outermost points nothing is known."""
    d = v_node(spark, sf)
    size = table(spark, sf, "part").select(F.col("p_partkey").alias("node"), F.col("p_size").cast("double").alias("x"))
    points = d.where("type = 'AA'").join(size, "node").select("gene", "x", F.col("psi").alias("y"))
    at = d.where("type <> 'AA'").select("gene", "node", (F.col("psi") * 50).alias("x"))
    return I.interpolate(points, at, ["gene"], 8).select("gene", "node", F.round("y", 9).alias("y"))


@query("SELECT p_brand AS gene, CAST(p_size AS BIGINT) AS score, min(md5(CAST(p_partkey AS VARCHAR))) AS pick FROM part GROUP BY ALL")
def w6_one_per_score(spark, sf):
    """One row for each score, picked by hash in place of a random permutation."""
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("gene"), F.col("p_size").cast("long").alias("score")).agg(F.min(F.md5(F.col("p_partkey").cast("string"))).alias("pick"))


# isoforms -------------------------------------------------------------------------------------------------------------------------------


def _genes(spark, sf) -> DataFrame:
    return v_exon(spark, sf).withColumn("gene", F.concat(F.col("chrom"), F.col("strand"), (F.floor(F.col("tx") / 200) % 100).cast("string"))).withColumn("tx", F.col("tx").cast("string"))


_GENES = "x AS (SELECT * REPLACE (CAST(tx AS VARCHAR) AS tx), chrom || strand || CAST(tx // 200 % 100 AS VARCHAR) AS gene FROM v_exon)"


@query(f'WITH {_GENES} SELECT gene, chrom, strand, CAST(min("start") AS BIGINT) AS "start", CAST(max("end") AS BIGINT) AS "end" FROM x GROUP BY ALL', "v_exon")
def a25_gene_extent(spark, sf):
    return G.gene_extents(_genes(spark, sf)).select("gene", "chrom", "strand", long("start"), long("end"))


@query(f"WITH {_GENES}, g AS (SELECT gene, chrom, max(\"end\") AS e FROM x GROUP BY ALL) SELECT gene, g.chrom FROM g JOIN (SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom, length(seq) AS size FROM v_dna) s ON s.chrom = g.chrom AND size > e", "v_exon", "v_dna")
def f19_chrom_size(spark, sf):
    sizes = v_dna(spark, sf).select(F.concat(F.lit("chr"), F.col("doc_id").cast("string")).alias("chrom"), F.length("seq").alias("size"))
    return G.in_chromosome(G.gene_extents(_genes(spark, sf)), sizes).select("gene", "chrom")


_MES = """m AS (SELECT DISTINCT chrom || '_' || strand || '_' || s || '_' || (s + 12) AS me, chrom, strand, sj_start, sj_end, s, s + 12 AS e FROM (SELECT chrom, strand, "start" AS sj_start, "end" AS sj_end, CAST("start" + 20 + tx % 4 AS INTEGER) AS s FROM v_intron WHERE "end" - "start" > 60))"""


def _mes(spark, sf) -> DataFrame:
    g = A.introns(v_exon(spark, sf)).where("end - start > 60")
    return _distinct_mes(exon_parts(spark, sf), g.select("chrom", "strand", F.col("start").alias("sj_start"), F.col("end").alias("sj_end"), (F.col("start") + 20 + F.col("tx") % 4).cast("int").alias("start"), (F.col("start") + 32 + F.col("tx") % 4).cast("int").alias("end")))


def _distinct_mes(parts: int, d: DataFrame) -> DataFrame:
    # dealt by place at once: to look a place up among exons then needs no other exchange
    return dealt(d, parts, "chrom", "strand", "start", "end").distinct().withColumn("me", K.me_id(F.col("chrom"), F.col("strand"), F.col("start"), F.col("end")))


_ENDS = f"""{_MES}, w AS (SELECT m.*, g.seq FROM m JOIN (SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom, seq FROM v_dna) g USING (chrom)),
z AS (SELECT me, sj_start, sj_end, strand, substr(seq, sj_start + 1, 12) AS l, substr(seq, sj_end - 11, 12) AS r FROM w WHERE sj_start <> s AND sj_end <> e)"""


@query(f"WITH {_ENDS} SELECT me, CAST(sj_start AS BIGINT) AS sj_start, CAST(sj_end AS BIGINT) AS sj_end, CASE WHEN strand = '-' THEN reverse(translate(r, 'ACGT', 'TGCA')) ELSE l END AS up, CASE WHEN strand = '-' THEN reverse(translate(l, 'ACGT', 'TGCA')) ELSE r END AS down FROM z", "v_intron", "v_dna")
def p36_intron_ends(spark, sf):
    """Ends of each junction's intron as long as the microexon, as the strand reads them, but for junctions that share a boundary with it."""
    d = _mes(spark, sf)
    edge = d.select(*d.columns).withColumns({"sj_end": F.col("end")})  # junctions that share a boundary: left out by the operator
    genome = v_dna(spark, sf).select(F.concat(F.lit("chr"), F.col("doc_id").cast("string")).alias("chrom"), "seq")
    return L.intron_end_sequences(d.unionByName(edge), genome, exon_parts(spark, sf)).select("me", long("sj_start"), long("sj_end"), "up", "down")


@query(f"WITH {_MES} SELECT me, CAST(sj_end AS BIGINT) AS sj_end, row_number() OVER (PARTITION BY chrom, strand, sj_end ORDER BY me, sj_start, sj_end) = 1 AS primary_me FROM m", "v_intron")
def a26_primary_secondary(spark, sf):
    return G.ranked_mes(_mes(spark, sf), "sj_end", exon_parts(spark, sf)).select("me", long("sj_end"), (F.col("rank") == 1).alias("primary_me"))


@query(f"WITH {_MES} SELECT DISTINCT me FROM m WHERE (chrom, strand, s, e) NOT IN (SELECT chrom, strand, \"start\", \"end\" FROM v_exon)", "v_intron")
def g1_skip_annotated(spark, sf):
    # dealt by place once, for the join and the distinct microexons, whose place is their name
    place = ["chrom", "strand", "start", "end"]
    new = _mes(spark, sf).join(v_exon(spark, sf).select(*place), place, "left_anti").select(*place).distinct()
    return new.select(K.me_id(*map(F.col, place)).alias("me"))


def _annotation(spark, sf) -> DataFrame:
    """The exons as a table, with what their transcripts tell of them: both for the microexons and for the introns they are put into."""
    x = G.in_transcripts(v_exon(spark, sf))
    gene = F.concat(F.col("chrom"), F.col("strand"), (F.floor(F.col("tx") / 200) % 100).cast("string"))
    return written(x.select(F.col("tx").cast("string").alias("tx"), gene.alias("gene"), "chrom", "strand", "start", "end", "i_end", "after", "tx_start", "tx_end", "k"), "exons")


def _mes_of(parts: int, x: DataFrame) -> DataFrame:
    """:func:`_mes` of the annotation's exons."""
    at = F.col("end") + 20 + F.col("tx").cast("long") % 4
    return _distinct_mes(parts, x.where("i_end - end > 60").select("chrom", "strand", F.col("end").alias("sj_start"), F.col("i_end").alias("sj_end"), at.cast("int").alias("start"), (at + 12).cast("int").alias("end")))


_ROUNDS = 4  # at most so many rounds decide all candidates of these tables


def _put_sql() -> str:
    """Candidates in the order of transcripts and introns; the first of each (gene, intron) whose microexon its transcript lacks so far wins."""
    intron = "gene, chrom, strand, i_start, i_end"
    out = f"""{_GENES}, {_MES}, n AS MATERIALIZED (SELECT * FROM m ANTI JOIN v_exon v ON v.chrom = m.chrom AND v.strand = m.strand AND v."start" = m.s AND v."end" = m.e),
a AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY chrom, strand, sj_start ORDER BY me, sj_start, sj_end) = 1), b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY chrom, strand, sj_end ORDER BY me, sj_start, sj_end) = 1),
gap AS (SELECT * EXCLUDE ("start", "end", block), "end" AS i_start, nxt AS i_end FROM (SELECT *, lead("start") OVER w AS nxt, lead("start", 2) OVER w AS after, row_number() OVER w AS k, min("start") OVER (PARTITION BY tx) AS ts, max("end") OVER (PARTITION BY tx) AS te
  FROM x WINDOW w AS (PARTITION BY tx ORDER BY "start", block)) WHERE nxt IS NOT NULL),
c0 AS MATERIALIZED (SELECT gap.tx, gap.gene, gap.i_start, gap.i_end, 2 * k AS turn, a.* FROM gap JOIN a ON a.chrom = gap.chrom AND a.strand = gap.strand AND a.sj_start = gap.i_start WHERE a.s > ts AND a.e < te
  UNION ALL SELECT gap.tx, gap.gene, gap.i_start, gap.i_end, 2 * k + 3, b.* FROM gap JOIN b ON b.chrom = gap.chrom AND b.strand = gap.strand AND b.sj_end = gap.i_end WHERE after IS NOT NULL AND b.s > ts AND b.e < te)"""
    for i in range(1, _ROUNDS + 1):
        out += f""",
r{i} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {intron} ORDER BY tx, turn) = 1 AND row_number() OVER (PARTITION BY tx, me ORDER BY turn) = 1 AS put FROM c{i - 1}),
c{i} AS MATERIALIZED (SELECT * EXCLUDE (put, barred) FROM (SELECT *, bool_or(put) OVER (PARTITION BY {intron}) OR bool_or(put) OVER (PARTITION BY tx, me) AS barred FROM r{i}) WHERE NOT barred)"""
    return out + ", p AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM r{i} WHERE put" for i in range(1, _ROUNDS + 1)) + ")"


_PUT = _put_sql()


@query(f'WITH {_PUT} SELECT tx, gene, me, CAST(s AS BIGINT) AS "start", CAST(e AS BIGINT) AS "end" FROM p', "v_intron")
def g2_inclusions(spark, sf):
    x, parts = _annotation(spark, sf), exon_parts(spark, sf)
    return G.inclusions(x, _mes_of(parts, x), parts=parts).select("tx", "gene", "me", long("start"), long("end"))


_ISO = f"""{_PUT}, i AS (SELECT tx, tx || '_' || string_agg(CAST(s + 1 AS VARCHAR), '.' ORDER BY s) AS new_tx FROM (SELECT DISTINCT tx, s FROM p) GROUP BY tx),
o AS (SELECT i.new_tx AS tx, i.tx AS "of", gene, chrom, strand, "start", "end" FROM x JOIN i USING (tx) WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.tx = x.tx AND p.s = x."start") AND NOT EXISTS (SELECT 1 FROM p WHERE p.tx = x.tx AND p.e = x."end")
  UNION SELECT i.new_tx, i.tx, gene, chrom, strand, s, e FROM p JOIN i USING (tx))"""


def _iso(spark, sf) -> DataFrame:
    x, parts = _annotation(spark, sf), exon_parts(spark, sf)
    return G.isoforms(x, G.inclusions(x, _mes_of(parts, x), parts=parts))


@query(f'WITH {_ISO} SELECT tx, gene, chrom, strand, CAST("start" AS BIGINT) AS "start", CAST("end" AS BIGINT) AS "end" FROM o', "v_intron")
def g2_isoforms(spark, sf):
    return _iso(spark, sf).select("tx", "gene", "chrom", "strand", long("start"), long("end"))


@query(
    f"""WITH {_PUT}, sec AS (SELECT f.me AS "primary", r.me AS secondary, r.s AS s2, r.e AS e2 FROM n r JOIN a f ON f.chrom = r.chrom AND f.strand = r.strand AND f.sj_start = r.sj_start AND f.me <> r.me
UNION SELECT f.me, r.me, r.s, r.e FROM n r JOIN b f ON f.chrom = r.chrom AND f.strand = r.strand AND f.sj_end = r.sj_end AND f.me <> r.me),
whole AS (SELECT tx, "start" AS s, "end" AS e, CAST(NULL AS VARCHAR) AS me FROM x UNION SELECT tx, s, e, me FROM p)
SELECT p.tx || '_' || (s2 + 1) || '_' || e2 || '_' || "primary" AS tx, "primary", secondary, CAST(CASE WHEN w.me = "primary" THEN s2 ELSE w.s END AS BIGINT) AS "start", CAST(CASE WHEN w.me = "primary" THEN e2 ELSE w.e END AS BIGINT) AS "end"
FROM p JOIN sec ON "primary" = p.me JOIN whole w ON w.tx = p.tx""",
    "v_intron",
)
def g4_secondary(spark, sf):
    """Exon rows of transcripts with a secondary microexon, by junction starts and junction ends."""
    x, parts = _annotation(spark, sf), exon_parts(spark, sf)
    mes = written(G.unannotated(x, _mes_of(parts, x)), "microexons")
    return G.secondary_isoforms(x, G.inclusions(x, mes, new=True, parts=parts), mes, new=True).select("tx", "primary", "secondary", long("start"), long("end"))


@query(
    f"""WITH {_ISO}, rows AS (SELECT 'transcript' AS feature, gene, tx, chrom, min("start") AS s, max("end") AS e FROM x GROUP BY gene, tx, chrom, strand UNION ALL SELECT 'exon', gene, tx, chrom, "start", "end" FROM x
  UNION ALL SELECT 'exon', gene, tx, chrom, "start", "end" FROM o UNION ALL SELECT 'transcript', n2.gene, n2.tx, n2.chrom, t.s, t.e FROM (SELECT DISTINCT tx, "of", gene, chrom FROM o) n2 JOIN (SELECT tx, min("start") AS s, max("end") AS e FROM x GROUP BY tx) t ON t.tx = n2."of")
SELECT 'gene' AS feature, chrom, CAST(min("start") AS BIGINT) AS "start", CAST(max("end") AS BIGINT) AS "end", 'gene_id "' || gene || '";' AS attributes FROM x GROUP BY gene, chrom, strand
UNION ALL SELECT feature, chrom, s, e, 'gene_id "' || gene || '"; transcript_id "' || tx || '";' FROM rows""",
    "v_intron",
)
def g3_gtf_rows(spark, sf):
    """Genes, their transcripts and exons, and the transcripts with microexons."""
    x, parts = _annotation(spark, sf), exon_parts(spark, sf)
    rows = G.gtf_rows(x).unionByName(G.new_gtf_rows(x, G.isoforms(x, G.inclusions(x, _mes_of(parts, x), parts=parts))))
    return rows.select("feature", "chrom", long("start"), long("end"), "attributes")


@query("SELECT p.tx, 'g' || CAST(p.key AS VARCHAR) AS gene FROM (SELECT CAST(p_partkey AS VARCHAR) || '.' || p_size AS tx, p_partkey AS key FROM part) p")
def g5_version_fallback(spark, sf):
    p = table(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    genes = p.select(F.when(F.col("p_partkey") % 2 == 0, F.concat(key, F.lit("."), F.col("p_size").cast("string"))).otherwise(F.concat(key, F.lit(".99"))).alias("tx"), F.concat(F.lit("g"), key).alias("gene"))
    return G.with_gene(p.select(F.concat(key, F.lit("."), F.col("p_size").cast("string")).alias("tx")), genes).select("tx", "gene")


@query(f"WITH {_PUT} SELECT tx, count(*) AS n FROM p GROUP BY tx", "v_intron")
def f20_inside_tx(spark, sf):
    x, parts = _annotation(spark, sf), exon_parts(spark, sf)
    return dealt(G.inclusions(x, _mes_of(parts, x), parts=parts), parts, "tx").groupBy("tx").agg(F.count("*").alias("n"))


# nodes, replicates, pools ---------------------------------------------------------------------------------------------------------------


@query("SELECT n.node, round(coalesce(m.psi, n.psi), 9) AS psi FROM v_node n LEFT JOIN (SELECT node, CASE WHEN node % 4 = 0 THEN NULL ELSE psi / 2 END AS psi FROM v_node JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A') ON l_partkey = node) m USING (node)", "v_node")
def j18_replace_psi(spark, sf):
    d = v_node(spark, sf).withColumn("coord", F.col("node"))
    listed = table(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_partkey").cast("long").alias("node")).distinct()
    mes = d.join(listed, "node", "left_semi").select("coord", F.when(F.col("node") % 4 != 0, F.col("psi") / 2).alias("psi"), F.lit(1).alias("row"))
    return D.replace_psi(d, mes).select("node", F.round("psi", 9).alias("psi"))


@query("SELECT gene, CAST(n AS VARCHAR) AS node, max(exon) AS exon FROM (SELECT gene, node AS exon, unnest([node, node + 1]) AS n FROM v_node) GROUP BY ALL", "v_node")
def j19_nodes(spark, sf):
    d = v_node(spark, sf).select("gene", F.col("node").alias("exon"), F.col("node").alias("row"), F.concat_ws(",", F.col("node").cast("string"), (F.col("node") + 1).cast("string")).alias("nodes"))
    return D.node_exons(d)


_FIX = """SELECT gene, node, chrom || '_' || strand || '_' || CASE WHEN takes THEN ("start" - 1 + CASE WHEN strand = '+' AND type = 'AD' OR strand = '-' AND type = 'AA' THEN -7 ELSE 0 END) || '_' || ("end" + CASE WHEN strand = '+' AND type = 'AA' OR strand = '-' AND type = 'AD' THEN 7 ELSE 0 END) ELSE ("start" - 1) || '_' || "end" END AS exon_id
FROM (SELECT *, type IN ('AA', 'AD') AND node % 3 <> 0 AS takes FROM v_node)"""


def _fixed(spark, sf) -> DataFrame:
    d = v_node(spark, sf)
    ends = ((F.col("strand") == "+") & (F.col("type") == "AD")) | ((F.col("strand") == "-") & (F.col("type") == "AA"))
    d = d.select("gene", "node", "chrom", "strand", "type", F.col("start").alias("n_start"), F.col("end").alias("n_end"))
    x = F.when(F.col("node") % 3 != 0, 0)
    return D.exon_of_node(d.withColumns({"x_start": F.col("n_start") + x - F.when(ends, 7).otherwise(0), "x_end": F.col("n_end") + x + F.when(ends, 0).otherwise(7)}))


@query(_FIX, "v_node")
def p33_node_fix(spark, sf):
    return _fixed(spark, sf).select("gene", "node", "exon_id")


@query(f"SELECT gene, node FROM ({_FIX}) WHERE exon_id IN (SELECT chrom || '_' || strand || '_' || (\"start\" - 1) || '_' || \"end\" FROM v_node WHERE psi > 0.5)", "v_node")
def j20_me_nodes(spark, sf):
    high = v_node(spark, sf).where("psi > 0.5").select(K.me_id(F.col("chrom"), F.col("strand"), F.col("start") - 1, F.col("end")).alias("exon_id"))
    return _fixed(spark, sf).join(high, "exon_id", "left_semi").select("gene", "node")


_REPS = """r AS (SELECT gene, node, chrom AS coord, strand, type, CASE WHEN (node + k) % 13 = 0 THEN NULL ELSE psi * k / 5 END AS psi_a, psi / 2 AS psi_b, psi * k / 5 - psi / 2 AS delta, CASE WHEN (node + k) % 11 = 0 THEN NULL ELSE (psi + k) / 6 END AS probability FROM v_node, range(1, 5) t(k))"""
_STATS = f"""{_REPS}, s AS (SELECT gene, node, coord, strand, type, CASE WHEN count(psi_a) = count(*) THEN avg(psi_a) END AS psi_a_mean, avg(psi_b) AS psi_b_mean, avg(delta) AS delta_mean, stddev_samp(delta) AS delta_sd, avg(probability) AS p_mean, stddev_samp(probability) AS p_sd, var_samp(probability) AS p_var, count(*) AS number FROM r GROUP BY ALL)"""


def _reps(spark, sf) -> DataFrame:
    d = v_node(spark, sf).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(4))))
    psi, k = F.col("psi"), F.col("k")
    return d.select("gene", "node", F.col("chrom").alias("coord"), "strand", "type", F.when((F.col("node") + k) % 13 != 0, psi * k / 5).alias("psi_a"), (psi / 2).alias("psi_b"), (psi * k / 5 - psi / 2).alias("delta"), F.when((F.col("node") + k) % 11 != 0, (psi + k) / 6).alias("probability"))


@query(f"WITH {_STATS} SELECT gene, node, type, round(psi_a_mean, 6) AS psi_a_mean, round(psi_b_mean, 6) AS psi_b_mean, round(delta_mean, 6) + 0.0 AS delta_mean, round(delta_sd, 6) AS delta_sd, round(p_mean, 6) AS p_mean, round(p_sd, 6) AS p_sd, round(p_var, 6) AS p_var, number FROM s", "v_node")
def a19_rep_stats(spark, sf):
    d = D.replicate_stats(_reps(spark, sf))
    return d.select("gene", "node", "type", *((F.round(c, 6) + 0.0).alias(c) for c in ("psi_a_mean", "psi_b_mean", "delta_mean", "delta_sd", "p_mean", "p_sd", "p_var")), "number")


#: The regularised incomplete beta function at 1/2 by its continued fraction, one term a step.
_T = "CASE WHEN j % 2 = 0 THEN (j // 2 + 1) * (q - (j // 2 + 1)) * z / ((p + 2 * (j // 2 + 1) - 1) * (p + 2 * (j // 2 + 1))) ELSE -(p + (j // 2 + 1)) * (p + q + (j // 2 + 1)) * z / ((p + 2 * (j // 2 + 1)) * (p + 2 * (j // 2 + 1) + 1)) END"
_CDF = f"""{_STATS}, k AS (SELECT *, CASE WHEN p_var > 0 AND p_mean > 0 AND p_mean < 1 THEN p_mean * (1 - p_mean) / p_var - 1 END AS k FROM s),
ab AS (SELECT *, CASE WHEN p_mean * k > 0 AND (1 - p_mean) * k > 0 THEN p_mean * k END AS a, (1 - p_mean) * k AS b FROM k),
pq AS (SELECT *, 0.5 > (a + 1) / (a + b + 2) AS swap, CASE WHEN 0.5 > (a + 1) / (a + b + 2) THEN b ELSE a END AS p, CASE WHEN 0.5 > (a + 1) / (a + b + 2) THEN a ELSE b END AS q, CAST(0.5 AS DOUBLE) AS z FROM ab),
cf AS (SELECT *, exp(lgamma(p + q) - lgamma(p) - lgamma(q) + (p + q) * ln(0.5)) / p * list_reduce(range(0, 600), lambda s, j: {{'c': 1 + ({_T}) / s.c, 'd': 1 / (1 + ({_T}) * s.d), 'h': s.h * (1 + ({_T}) / s.c) / (1 + ({_T}) * s.d)}},
  {{'c': CAST(1 AS DOUBLE), 'd': 1 / (1 - (p + q) * z / (p + 1)), 'h': 1 / (1 - (p + q) * z / (p + 1))}}).h AS half FROM pq WHERE a IS NOT NULL),
v AS (SELECT pq.*, CASE WHEN pq.swap THEN 1 - half ELSE half END AS cdf FROM pq LEFT JOIN cf USING (gene, node))"""


@query(f"WITH {_CDF} SELECT gene, node, round(cdf, 6) + 0.0 AS cdf FROM v", "v_node")
def p34_beta_cdf(spark, sf):
    d = D.replicate_stats(_reps(spark, sf))
    return d.select("gene", "node", (F.round(N.beta_probability(F.lit(0.5), F.col("p_mean"), F.col("p_var")), 6) + 0.0).alias("cdf"))


@query(f"WITH {_CDF} SELECT gene, node, type, number, coalesce(abs(delta_mean) >= 0.1 AND cdf < 0.05 AND p_mean >= 0.4 AND type NOT IN ('TE', 'TS') AND number > 3, FALSE) AS diff FROM v", "v_node")
def f17_diff(spark, sf):
    return D.significant(D.replicate_stats(_reps(spark, sf)), 0.5, 0.1, 0.4, 3).select("gene", "node", "type", "number", "diff")


@query("SELECT cluster, string_agg(CAST(file AS VARCHAR), ',' ORDER BY CAST(file AS VARCHAR)) AS files, count(*) AS n FROM v_cell GROUP BY cluster", "v_cell")
def d1_cluster_files(spark, sf):
    return D.cluster_files(v_cell(spark, sf).withColumn("file", F.col("file").cast("string")))


def _comparisons(spark) -> DataFrame:
    rows = [("c1", "A", "BUILDING,MACHINERY", 4, 3), ("c1", "B", "AUTOMOBILE", 3, 3), ("c2", "A", "HOUSEHOLD", 5, 2), ("c2", "B", "FURNITURE, NOBODY", 2, 2)]
    return spark.createDataFrame(rows, "comparison string, side string, clusters string, n_pools int, repeats int")


_CMP = "c AS (SELECT * FROM (VALUES ('c1', 'A', 'BUILDING', 4, 3), ('c1', 'A', 'MACHINERY', 4, 3), ('c1', 'B', 'AUTOMOBILE', 3, 3), ('c2', 'A', 'HOUSEHOLD', 5, 2), ('c2', 'B', 'FURNITURE', 2, 2), ('c2', 'B', 'NOBODY', 2, 2)) t(comparison, side, cluster, n_pools, repeats))"


@query(f"WITH {_CMP}, r AS (SELECT *, unnest(range(1, repeats + 1)) AS rep FROM c) SELECT comparison, side, CAST(rep AS INTEGER) AS rep, CAST((row_number() OVER (PARTITION BY comparison, side, rep ORDER BY md5('123|' || rep || '|' || file), file) - 1) % n_pools + 1 AS INTEGER) AS pool, file FROM r JOIN v_cell USING (cluster)", "v_cell")
def d3_pools(spark, sf):
    return D.pools(_comparisons(spark), v_cell(spark, sf), 123)


@query(f"WITH {_CMP} SELECT DISTINCT comparison, cluster FROM c WHERE cluster NOT IN (SELECT cluster FROM v_cell)", "v_cell")
def d6_missing_clusters(spark, sf):
    return D.missing_clusters(_comparisons(spark), v_cell(spark, sf))


@query("SELECT c_nationkey, count(*) AS n, CAST(greatest(3, round_even(count(*) / 15, 0)) AS INTEGER) AS bulks FROM customer GROUP BY 1")
def d4_pseudobulk(spark, sf):
    d = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return d.withColumn("bulks", D.pseudo_bulk_count(F.col("n")))


@query(
    """WITH n AS (SELECT *, count(*) OVER (PARTITION BY cluster) AS k FROM v_cell), b AS (SELECT cluster, file, CAST((row_number() OVER (PARTITION BY cluster ORDER BY md5('123|' || file), file) - 1) % CAST(greatest(3, round_even(k / 15, 0)) AS INTEGER) + 1 AS INTEGER) AS bulk FROM n)
SELECT cluster, bulk, string_agg(CAST(file AS VARCHAR), ',' ORDER BY file) AS files FROM b GROUP BY ALL""",
    "v_cell",
)
def d5_membership(spark, sf):
    return D.membership(v_cell(spark, sf), 123)


@query(f"WITH {_CMP} SELECT comparison, side, file FROM c JOIN v_cell USING (cluster)", "v_cell")
def j23_cluster_files(spark, sf):
    c = _comparisons(spark).select("comparison", "side", F.explode(F.split("clusters", ", *")).alias("cluster"))
    return c.join(v_cell(spark, sf), "cluster").select("comparison", "side", "file")


@query("SELECT sample, me, rep FROM (SELECT sample, me, 'rep' || sample % 3 AS rep FROM v_cov)", "v_cov")
def u4_replicates(spark, sf):
    cov = v_cov(spark, sf).select("sample", "me")
    parts = [cov.where(F.col("sample") % 3 == i).withColumn("rep", F.lit(f"rep{i}")) for i in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT file, user_id, regexp_extract(file, '([^/]*)[.]psi[.]gz$', 1) AS sample FROM (SELECT 'quant/s' || user_id || '.psi.gz' AS file, CAST(user_id AS BIGINT) AS user_id FROM events GROUP BY user_id)")
def p38_sample_col(spark, sf):
    d = table(spark, sf, "events").select(F.col("user_id").cast("long").alias("user_id")).distinct().withColumn("file", F.concat(F.lit("quant/s"), F.col("user_id").cast("string"), F.lit(".psi.gz")))
    return D.merge_quant(d.withColumn("f", F.col("file"))).withColumnRenamed("f", "file")


@query("SELECT sample || chr(9) || me || '|' || inc || ',' || skip AS line FROM v_cov", "v_cov")
def p47_join_text(spark, sf):
    return v_cov(spark, sf).select(F.concat(F.col("sample").cast("string"), F.lit("\t"), F.concat_ws("|", "me", F.concat_ws(",", F.col("inc").cast("string"), F.col("skip").cast("string")))).alias("line"))


# sets -----------------------------------------------------------------------------------------------------------------------------------


@query("SELECT kind, count(*) AS n FROM (SELECT event_type AS kind FROM events UNION ALL SELECT l_linestatus FROM lineitem UNION ALL SELECT o_orderstatus FROM orders) GROUP BY 1")
def u1_union(spark, sf):
    """Tables of several files under one another."""
    parts = [table(spark, sf, t).select(F.col(c).alias("kind")) for t, c in (("events", "event_type"), ("lineitem", "l_linestatus"), ("orders", "o_orderstatus"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT me, 'new' AS origin FROM v_cov WHERE inc > skip UNION ALL SELECT me, 'db' FROM v_cov WHERE inc < skip", "v_cov")
def u2_union_two(spark, sf):
    c = v_cov(spark, sf)
    return c.where("inc > skip").select("me", F.lit("new").alias("origin")).unionByName(c.where("inc < skip").select("me", F.lit("db").alias("origin")))


@query("SELECT sample, CAST(sum(inc) AS BIGINT) AS inc FROM v_cov GROUP BY sample", "v_cov")
def u3_merge_quant(spark, sf):
    d = v_cov(spark, sf).withColumn("file", F.concat(F.lit("q/"), F.col("sample").cast("string"), F.lit(".tab.gz"))).drop("sample")
    return D.merge_quant(d).groupBy(F.col("sample").cast("long").alias("sample")).agg(F.sum("inc").alias("inc"))


@query("SELECT DISTINCT o_custkey AS me FROM orders WHERE o_totalprice > 150000 EXCEPT SELECT c_custkey FROM customer WHERE c_nationkey < 12")
def u5_novel(spark, sf):
    found = table(spark, sf, "orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("me"))
    return L.novelty(found, table(spark, sf, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("me"))).where("novel = 1").select("me")


@query("SELECT coalesce(f.me, a.me) AS me, CASE WHEN a.me IS NULL THEN 1 ELSE 0 END AS novel FROM (SELECT DISTINCT o_custkey AS me FROM orders) f FULL JOIN (SELECT c_custkey AS me FROM customer WHERE c_nationkey < 12) a ON a.me = f.me")
def u6_novel_flag(spark, sf):
    return L.novelty(table(spark, sf, "orders").select(F.col("o_custkey").alias("me")), table(spark, sf, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("me")))


@query("SELECT DISTINCT l_suppkey, l_linestatus FROM lineitem")
def u8_distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_linestatus").distinct()


# regions --------------------------------------------------------------------------------------------------------------------------------


@query("SELECT gene, node, least(coalesce(lag(\"start\", 2) OVER w, lag(\"start\", 1) OVER w, \"start\"), coalesce(lead(\"end\", 2) OVER w, lead(\"end\", 1) OVER w, \"end\")) AS \"from\", greatest(coalesce(lag(\"start\", 2) OVER w, lag(\"start\", 1) OVER w, \"start\"), coalesce(lead(\"end\", 2) OVER w, lead(\"end\", 1) OVER w, \"end\")) AS \"to\" FROM v_node WINDOW w AS (PARTITION BY gene ORDER BY node)", "v_node")
def p40_node_region(spark, sf):
    return R.neighbourhood(v_node(spark, sf))


@query("SELECT gene, node, lag(node, 2) OVER w AS lag2, lead(node, 2) OVER w AS lead2 FROM v_node WINDOW w AS (PARTITION BY gene ORDER BY node)", "v_node")
def w8_neighbours(spark, sf):
    return R.neighbours(v_node(spark, sf)).select("gene", "node", F.col("before").alias("lag2"), F.col("behind").alias("lead2"))


@query("SELECT gene, node, chrom || ':' || (\"start\" - 499) || '-' || (\"end\" + 500) AS region FROM v_node", "v_node")
def p39_window(spark, sf):
    return v_node(spark, sf).select("gene", "node", K.coordinate(F.col("chrom"), F.col("start") - 500, F.col("end") + 500).alias("region"))


@query('WITH g AS (SELECT tx, "start" AS s, "end" AS e, ("end" - "start") - CAST(floor(pow("end" - "start", 0.7)) AS BIGINT) AS saved FROM v_intron) SELECT tx AS "group", CAST(s AS BIGINT) AS "start", CAST(s - before AS BIGINT) AS new_start, CAST(e - before - saved AS BIGINT) AS new_end FROM (SELECT *, coalesce(sum(saved) OVER (PARTITION BY tx ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)', "v_intron")
def p43_shrink(spark, sf):
    return R.shrink(A.introns(v_exon(spark, sf)).withColumnRenamed("tx", "group")).select("group", long("start"), "new_start", "new_end")


@query(
    f"""WITH c AS ({_CUT}), e AS (SELECT line AS sample, chrom, unnest(b) AS x FROM c), v AS (SELECT sample, chrom, pos, sum(d) AS d FROM (SELECT sample, chrom, x[1] AS pos, 1 AS d FROM e UNION ALL SELECT sample, chrom, x[2], -1 FROM e) GROUP BY ALL HAVING sum(d) <> 0),
g AS (SELECT s AS sample, s % 3 AS grp FROM (SELECT unnest(range(1, 10)) AS s)), k AS (SELECT DISTINCT grp, chrom, pos FROM v JOIN g USING (sample)),
a AS (SELECT grp, sample, chrom, pos, d FROM v JOIN g USING (sample) UNION ALL SELECT k.grp, g.sample, chrom, pos, 0 FROM k JOIN g ON g.grp = k.grp),
s AS (SELECT grp, sample, chrom, pos, sum(d) AS d FROM a GROUP BY ALL), r AS (SELECT grp, chrom, pos, sum(d) OVER (PARTITION BY grp, sample, chrom ORDER BY pos ROWS UNBOUNDED PRECEDING) AS depth FROM s),
m AS (SELECT grp, chrom, pos, avg(depth) AS mean, median(depth) AS median, sum(depth) AS total FROM r GROUP BY ALL)
SELECT CAST(grp AS BIGINT) AS "group", chrom, CAST(pos AS BIGINT) AS "start", CAST(nxt AS BIGINT) AS "end", round(mean, 6) AS mean, CAST(median AS DOUBLE) AS median, CAST(total AS BIGINT) AS total
FROM (SELECT *, lead(pos) OVER (PARTITION BY grp, chrom ORDER BY pos) AS nxt FROM m) WHERE total > 0""",
    "v_align",
)
def a27_overlay_stats(spark, sf):
    """Coverage of the samples of three groups laid over each other; two samples have no reads."""
    depths = R.base_coverage(v_align(spark, sf).withColumnRenamed("line", "sample"), ("sample", "chrom"))
    samples = spark.range(1, 10).select((F.col("id") % 3).alias("group"), F.col("id").cast("int").alias("sample"))
    return R.overlay(depths, samples).select("group", "chrom", "start", "end", F.round("mean", 6).alias("mean"), "median", "total")


@query("SELECT \"start\" AS x, tag AS xend, CAST(max(score) AS INTEGER) AS y, CAST(max(line) AS INTEGER) AS yend, CAST(sum(score) AS BIGINT) AS n, string_agg(CAST(supp AS VARCHAR), ',' ORDER BY CAST(supp AS VARCHAR)) AS labels FROM v_align GROUP BY ALL", "v_align")
def a28_junction_merge(spark, sf):
    d = v_align(spark, sf).select(F.col("start").alias("x"), F.col("tag").alias("xend"), F.col("score").alias("y"), F.col("line").alias("yend"), F.col("score").alias("n"), F.col("supp").cast("string").alias("label"))
    return R.merge_junctions(d)


@query(
    """WITH l AS (SELECT chrom || strand AS grp, list_sort(list(DISTINCT {'s': "start", 'e': "end"})) AS g FROM v_intron GROUP BY 1),
f AS (SELECT grp, list_reduce(g[2:], lambda a, x: CASE WHEN x.s < a.e THEN {'done': a.done, 's': greatest(a.s, x.s), 'e': least(a.e, x.e)} ELSE {'done': list_append(a.done, {'s': a.s, 'e': a.e}), 's': x.s, 'e': x.e} END,
  {'done': list_filter(g, lambda y: FALSE), 's': g[1].s, 'e': g[1].e}) AS r FROM l)
SELECT grp AS "group", CAST(u.s AS BIGINT) AS "start", CAST(u.e AS BIGINT) AS "end" FROM (SELECT grp, unnest(list_append(r.done, {'s': r.s, 'e': r.e})) AS u FROM f)""",
    "v_intron",
)
def a29_intersect_runs(spark, sf):
    g = A.introns(v_exon(spark, sf)).withColumn("group", F.concat("chrom", "strand"))
    return R.intersect_runs(g, exon_parts(spark, sf)).select("group", long("start"), long("end"))


@query("SELECT chrom, count(*) AS n FROM v_exon WHERE \"end\" > 500 AND \"start\" < 900 GROUP BY chrom", "v_exon")
def f21_region_overlap(spark, sf):
    return v_exon(spark, sf).where("end > 500 and start < 900").groupBy("chrom").agg(F.count("*").alias("n"))


@query("SELECT chrom, \"start\", supp, count(*) AS n FROM v_align GROUP BY ALL HAVING count(*) >= 2", "v_align")
def f22_min_cov(spark, sf):
    return v_align(spark, sf).groupBy("chrom", "start", "supp").agg(F.count("*").alias("n")).where("n >= 2")


@query("SELECT sample, count(*) AS n, CAST(sum(inc) AS BIGINT) AS inc FROM v_cov GROUP BY sample", "v_cov")
def u9_split_by_sample(spark, sf):
    """What a report partitioned by sample holds."""
    return v_cov(spark, sf).groupBy("sample").agg(F.count("*").alias("n"), F.sum("inc").alias("inc"))


@query(
    """WITH c AS (SELECT DISTINCT tag || '_' || supp AS key, 'm' || (read % 50000) AS me, line / 10 AS u2 FROM v_align), k AS (SELECT tag || '_' || supp AS key, count(DISTINCT read) AS coverage, min(score / 100) AS p FROM v_align GROUP BY 1),
d AS (SELECT DISTINCT key, me FROM c), g AS (SELECT DISTINCT keys FROM (SELECT list_sort(list(DISTINCT b.key)) AS keys FROM d a JOIN d b USING (me) GROUP BY a.key)),
u AS (SELECT array_to_string(keys, ',') AS total_sjs, len(keys) AS n, unnest(keys) AS key FROM g),
t AS (SELECT total_sjs, me, u2 FROM u JOIN c USING (key) GROUP BY total_sjs, n, me, u2 HAVING count(*) = n), b AS (SELECT total_sjs, max({'u2': u2, 'me': me}) AS b, count(*) AS n_matches FROM t GROUP BY 1),
s AS (SELECT total_sjs, CAST(sum(coverage) AS BIGINT) AS sum_coverage, min(p) AS p_me, string_agg(CAST(coverage AS VARCHAR), ',' ORDER BY key) AS total_coverages FROM u JOIN k USING (key) GROUP BY 1)
SELECT b.b.me AS me, b.b.u2 AS u2, CAST(1.0 AS DOUBLE) AS cons, sum_coverage, total_sjs, total_coverages, n_matches, p_me FROM b JOIN s USING (total_sjs)""",
    "v_align",
)
def a8_centric(spark, sf):
    d = v_align(spark, sf)
    rows = d.groupBy(F.concat_ws("_", "tag", "supp").alias("key")).agg(F.countDistinct("read").alias("coverage"), F.min(F.col("score") / 100).alias("p_spurious"), F.array_sort(F.collect_set(F.struct(F.concat(F.lit("m"), (F.col("read") % 50000).cast("string")).alias("me"), (F.col("line") / 10).alias("u2"), F.lit(1.0).alias("cons")))).alias("candidates"))
    return X.centric(rows).drop("total")
