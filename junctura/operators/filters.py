"""Final filters: mixture-based P-values, the threshold by length periodicity, three-way classes, high-quality routing, novelty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from .genome import with_slices


def explode_matches(total: DataFrame) -> DataFrame:
    """(row columns, me, u2, cons) of ``total_me``: ``ME|U2|cons`` in a comma list."""
    rest = [c for c in total.columns if c != "total_me"]
    part = lambda i: F.get(F.split("m", r"\|"), i)
    return total.select(*rest, F.explode(F.split("total_me", ",")).alias("m")).select(*rest, part(0).alias("me"), part(1).try_cast("double").alias("u2"), part(2).try_cast("double").alias("cons"))


def detected(rows: DataFrame, n_samples: DataFrame, least: int) -> DataFrame:
    """Microexons found in at least ``least`` samples, with ``short``: fewer than 3 bases."""
    return rows.join(n_samples.where(F.col("n_samples") >= least).select("me"), "me", "left_semi").withColumn("short", F.col("len") < 3)


def length_histogram(rows: DataFrame, lo: float = 0.10, hi: float = 1.00, step: float = 0.01) -> DataFrame:
    """(threshold, len, n): microexons of each length whose P-value is at most each threshold; only thresholds that any reach."""
    d = rows.withColumn("i", F.greatest(F.ceil(F.round((F.col("p") - lo) / step, 6)), F.lit(0)).cast("int")).groupBy("len", "i").agg(F.count("*").alias("k"))
    last = round((hi - lo) / step)
    # each count stands for its own threshold and all above: at most (last + 1) rows for a (len, i)
    all_i = d.where(F.col("i") <= last).select("len", "k", F.explode(F.sequence(F.col("i"), F.lit(last))).alias("i"))
    return all_i.groupBy("i", "len").agg(F.sum("k").alias("n")).select(F.round(lo + F.col("i") * step, 2).alias("threshold"), "len", "n")


def residual_sigma(hist: DataFrame) -> DataFrame:
    """For each threshold the residual deviations of ``n ~ len``, of lengths divisible by 3 and of the others, summed; null with under 3 lengths in a class."""
    by = hist.groupBy("threshold", (F.col("len") % 3 == 0).alias("frame")).agg(F.count("*").alias("m"), F.regr_syy("n", "len").alias("syy"), F.regr_sxy("n", "len").alias("sxy"), F.regr_sxx("n", "len").alias("sxx"))
    sigma = F.when((F.col("m") >= 3) & (F.col("sxx") > 0), F.sqrt(F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0)) / (F.col("m") - 2)))
    both = by.withColumn("sigma", sigma).groupBy("threshold").agg(F.count("sigma").alias("classes"), F.sum("sigma").alias("sigma"))
    return both.select("threshold", F.when(F.col("classes") == 2, F.col("sigma")).alias("sigma"))


def best_threshold(sigmas: DataFrame) -> DataFrame:
    """The threshold with the least summed deviation; the smallest of equals."""
    return sigmas.where("sigma is not null").agg(F.min(F.struct("sigma", "threshold")).alias("b")).select(F.col("b.threshold").alias("threshold"), F.col("b.sigma").alias("sigma"))


def classify(p, threshold, cons, min_cons):
    """IN up to the threshold, RESCUED if well conserved, else OUT; null P-values have no class."""
    return F.when(p.isNull(), None).when(p <= threshold, "IN").when(cons >= min_cons, "RESCUED").otherwise("OUT")


def up_down_totals(cov: DataFrame) -> DataFrame:
    return cov.groupBy("me").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))


def shared_boundaries(mes: DataFrame) -> DataFrame:
    """For each microexon the number of distinct ones with its start plus that with its end."""
    d = mes.select("me", "chrom", "strand", "start", "end").distinct()
    starts = d.groupBy("chrom", "strand", "start").agg(F.countDistinct("me").alias("n_start"))
    ends = d.groupBy("chrom", "strand", "end").agg(F.countDistinct("me").alias("n_end"))
    return d.join(starts, ["chrom", "strand", "start"]).join(ends, ["chrom", "strand", "end"]).select("me", (F.col("n_start") + F.col("n_end")).alias("share"))


def intron_end_sequences(mes: DataFrame, genome: DataFrame, parts: int | None = None) -> DataFrame:
    """First and last bases (``up``, ``down``) of each junction's intron, as many as the microexon has and as its strand reads them.

    ``mes`` (me, chrom, strand, sj_start, sj_end, start, end).  A junction that starts or ends where the microexon does is left out.
    """
    n = F.col("end") - F.col("start")
    windows = {"__l": (F.col("sj_start"), F.col("sj_start") + n), "__r": (F.col("sj_end") - n, F.col("sj_end"))}
    d = with_slices(mes.where("sj_start <> start and sj_end <> end"), genome, windows, parts=parts)
    minus = F.col("strand") == "-"
    return d.select(*mes.columns, F.when(minus, S.revcomp("__r")).otherwise(F.col("__l")).alias("up"), F.when(minus, S.revcomp("__l")).otherwise(F.col("__r")).alias("down"))


def route(rows: DataFrame) -> DataFrame:
    """Rows (me, up, down, share, in_intron_end) with ``balance`` and ``route``: null without reads, drop, ambiguous or high."""
    balance = F.when(F.col("up") + F.col("down") > 0, F.abs(F.col("up") - F.col("down")) / (F.col("up") + F.col("down")))
    d = rows.withColumn("balance", balance)
    return d.withColumn("route", F.when(F.col("balance").isNull(), None).when((F.col("share") > 2) & (F.col("balance") > 0.95), "drop").when(F.col("in_intron_end"), "ambiguous").otherwise("high"))


def zscore_threshold(hist: DataFrame) -> DataFrame:
    """The older criterion: z-scores of counts over lengths, lengths 3 to 5 summed less those from 6 on, by threshold."""
    by = hist.groupBy("threshold").agg(F.avg("n").alias("mean"), F.stddev_samp("n").alias("sd"))
    z = hist.join(by, "threshold").withColumn("z", F.when(F.col("sd") > 0, (F.col("n") - F.col("mean")) / F.col("sd")))
    return z.groupBy("threshold").agg(F.sum(F.when(F.col("len").between(3, 5), F.col("z"))).alias("short_z"), F.sum(F.when(F.col("len") >= 6, F.col("z"))).alias("long_z"))


def log_ratio(first: DataFrame, second: DataFrame) -> DataFrame:
    """Total coverage of both rounds and the binary logarithm of their ratio, null where either is 0."""
    d = first.groupBy("me").agg(F.sum("n").alias("n1")).join(second.groupBy("me").agg(F.sum("n").alias("n2")), "me")
    return d.withColumn("log2_ratio", F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.log2(F.col("n2") / F.col("n1"))))


def novelty(found: DataFrame, annotated: DataFrame) -> DataFrame:
    """All microexons of both tables once, with novel 1 for those found only."""
    a = annotated.select("me").distinct().withColumn("known", F.lit(1))
    f = found.select("me").distinct()
    return f.join(a, "me", "full").select("me", F.when(F.col("known").isNull(), 1).otherwise(0).alias("novel"))
