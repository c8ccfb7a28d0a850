"""Quantification: read counts of junction and microexon tags, coverage of alternative exons, inclusion levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import binomial_interval
from .annotation import but_last
from .dealing import dealt

ANCHOR = 8


def ungapped(sam: DataFrame) -> DataFrame:
    """Mapped alignments of one matching block."""
    return sam.where((F.col("flag").bitwiseAND(4) == 0) & F.col("cigar").rlike(r"^\d+M$"))


def anchored(reads: DataFrame, anchor: int = ANCHOR) -> DataFrame:
    """Reads that reach ``anchor`` bases beyond a junction of their tag: (start, matched, up, me_len or null)."""
    over = lambda at: (F.col("start") <= at - anchor) & (F.col("start") + F.col("matched") >= at + anchor)
    return reads.where(over(F.col("up")) | (F.col("me_len").isNotNull() & over(F.col("up") + F.coalesce("me_len", F.lit(0)))))


def tag_counts(reads: DataFrame, anchor: int = ANCHOR) -> DataFrame:
    """Reads by tag: all, over the upstream junction, else over the downstream one, and distinct sequences of both."""
    over = lambda at: (F.col("start") <= at - anchor) & (F.col("start") + F.col("matched") >= at + anchor)
    up = F.col("me_len").isNotNull() & over(F.col("up"))
    down = F.col("me_len").isNotNull() & ~over(F.col("up")) & over(F.col("up") + F.coalesce("me_len", F.lit(0)))
    return reads.groupBy("tag").agg(F.count("*").alias("reads"), F.count_if(up).alias("up_reads"), F.count_if(down).alias("down_reads"), F.countDistinct(F.when(up | down, F.col("seq"))).alias("distinct_seqs"))


def with_counts(me_sjs: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (me, sj, me_tag) with the reads of both tags; absent counts are 0."""
    named = lambda key, out: counts.select(F.col("tag").alias(key), F.col("reads").alias(out))
    return me_sjs.join(named("sj", "sj_reads"), "sj", "left").join(named("me_tag", "me_reads"), "me_tag", "left").na.fill(0, ["sj_reads", "me_reads"])


def me_sums(me_sjs: DataFrame, counts: DataFrame) -> DataFrame:
    """Per microexon the coverage of its junctions with and without it: rows (me, sj, me_tag) against counts (tag, reads); absent counts are 0."""
    d = with_counts(me_sjs, counts)
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sj", c))), lambda x: x[c].cast("string")), ",")
    return d.groupBy("me").agg(F.array_join(F.array_sort(F.collect_list("sj")), ",").alias("total_sjs"), listed("me_reads").alias("me_coverages"), F.sum("me_reads").alias("sum_me"), listed("sj_reads").alias("sj_coverages"), F.sum("sj_reads").alias("sum_sj"))


_KINDS = ("alt3", "alt5")


def _sides(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Two rows for each: the boundary ``at`` that counts for each ``kind``, as the row's strand reads it."""
    left, right = F.when(F.col("strand") == "-", F.col(end)).otherwise(F.col(start)), F.when(F.col("strand") == "-", F.col(start)).otherwise(F.col(end))
    return rows.select("*", F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), at.alias("at")) for k, at in zip(_KINDS, (left, right), strict=True)))))


def boundary_partners(mes: DataFrame, exons: DataFrame, me_len: int, parts: int | None = None) -> DataFrame:
    """Longer exons (me, chrom, e_start, e_end, kind) that begin or end where a microexon does, by strand; kind is alt5 or alt3.

    A transcript's last exon (by place) is no partner, as in the coverage table that this mirrors; an exon that another transcript has inside counts.
    """
    e = but_last(exons).where(F.col("end") - F.col("start") > me_len).select("chrom", "strand", F.col("start").alias("e_start"), F.col("end").alias("e_end"))
    e = dealt(e, parts, "chrom", "strand", "e_start", "e_end").distinct()
    at = ["chrom", "kind", "at"]
    hit = dealt(_sides(mes, "start", "end"), parts, *at).join(_sides(e, "e_start", "e_end").drop("strand"), at)
    return hit.where("not (e_start = start and e_end = end)").select("me", "chrom", "e_start", "e_end", "kind")


def _beside(both: DataFrame, gaps: DataFrame, how: str, parts: int | None = None) -> DataFrame:
    """Partners with the introns that end at their start (L) or start at their end (R): one join for both sides."""
    at = lambda side, here, other: F.struct(F.lit(side).alias("side"), F.col(here).alias("at"), *([F.col(other).alias("other")] if other else []))
    mine = both.select("*", F.inline(F.array(at("L", "e_start", None), at("R", "e_end", None))))
    theirs = gaps.select("chrom", "n", F.inline(F.array(at("L", "end", "start"), at("R", "start", "end"))))
    return dealt(mine, parts, "chrom", "side", "at").join(theirs, ["chrom", "side", "at"], how).select("me", "kind", "e_start", "e_end", F.when(F.col("n").isNotNull(), F.concat_ws("|", "side", "at", "other")).alias("intron"), "n")


def adjacent_introns(both: DataFrame, gaps: DataFrame, parts: int | None = None) -> DataFrame:
    """Introns that end at a partner's start or start at its end, with their counts: (me, kind, e_start, e_end, intron, n)."""
    return _beside(both, gaps, "inner", parts)


def alternative_exons(mes: DataFrame, exons: DataFrame, gaps: DataFrame, me_len: int, parts: int | None = None) -> DataFrame:
    """Coverage of exons that share a boundary with a microexon.

    ``mes`` (me, chrom, strand, start, end), ``exons`` (tx, block, chrom, strand, start, end), ``gaps`` (chrom, start, end, n): intron counts.  An exon's coverage
    sums the introns that end at its start or start at its end; a microexon's total sums distinct (boundary, intron) counts.  Boundaries have no strand, as
    introns are keyed by place.  Returns (me, kind, exons, total) with kind alt5 or alt3.
    """
    hit = _beside(boundary_partners(mes, exons, me_len, parts), gaps, "left", parts)
    # each hit counts for its exon and, once for all exons, for its intron
    none = F.lit(None)
    of_exon = F.struct(F.col("e_start").alias("s"), F.col("e_end").alias("e"), none.cast("string").alias("i"))
    of_intron = F.struct(none.cast("int").alias("s"), none.cast("int").alias("e"), F.col("intron").alias("i"))
    # dealt once by the columns of the last grouping, which the first has, too
    both = dealt(hit.select("me", "kind", "n", F.inline(F.array(of_exon, of_intron))), parts, "me", "kind").groupBy("me", "kind", "s", "e", "i").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("cov"), F.max("n").alias("n"))
    listed = F.array_sort(F.collect_list(F.when(F.col("s").isNotNull(), F.struct("s", "e", "cov"))))
    text = F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"), x["cov"].cast("string"))), ",")
    return both.groupBy("me", "kind").agg(text.alias("exons"), F.coalesce(F.sum(F.when(F.col("i").isNotNull(), F.col("n"))), F.lit(0)).alias("total"))


def samples_passing(cov: DataFrame, least: int) -> DataFrame:
    """Number of samples in which a microexon reaches ``least`` distinct sequences; 0 is kept."""
    return cov.groupBy("me").agg(F.count_if(F.col("inc") >= least).alias("n_samples"))


def psi(cov: DataFrame, least: int) -> DataFrame:
    """Inclusion ``inc / (inc + skip)`` with the exact interval, both null below ``least`` reads."""
    n = F.col("inc") + F.col("skip")
    d = cov.withColumn("psi", F.when((n >= least) & (n > 0), F.col("inc") / n))
    ci = binomial_interval(F.when(n >= least, F.col("inc")), F.when(n >= least, n))
    return d.withColumn("ci", ci).select(*cov.columns, "psi", F.col("ci.lo").alias("ci_lo"), F.col("ci.hi").alias("ci_hi"))


def mates(cov: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both samples of each pair side by side, where both have the microexon."""
    other = cov.select(F.col("sample").alias("pair2"), "me", F.col("inc").alias("mate_inc"), F.col("skip").alias("mate_skip"))
    return cov.withColumnRenamed("sample", "pair1").join(pairs, "pair1").join(other, ["pair2", "me"])


def pair_samples(cov: DataFrame, pairs: DataFrame) -> DataFrame:
    """Paired samples summed under the first name; a missing mate counts 0, samples outside the pairs stay."""
    named = pairs.select(F.col("pair2").alias("sample"), F.col("pair1").alias("first"))
    d = cov.join(named, "sample", "left").withColumn("sample", F.coalesce("first", "sample"))
    return d.groupBy("sample", "me").agg(F.sum("inc").alias("inc"), F.sum("skip").alias("skip"))


def alternative_psi(rows: DataFrame, least: int) -> DataFrame:
    """Inclusion of alternative exons: rows (me, strand, start, end, inc, skip, total5, total3, kind, alt_start, alt_end, cov).

    The denominator counts the microexon's reads twice and is gated on the same sum; the region is what the alternative exon has
    beyond the microexon, 1-based.
    """
    n = F.col("inc") + F.col("skip") + F.col("total5") + F.col("total3") + F.col("inc")
    left = ((F.col("kind") == "alt5") & (F.col("strand") == "+")) | ((F.col("kind") == "alt3") & (F.col("strand") == "-"))
    d = rows.withColumn("alt_psi", F.when((n >= least) & (n > 0), F.col("cov") / n))
    return d.withColumns({"from": F.when(left, F.col("alt_start") + 1).otherwise(F.col("end") + 1), "to": F.when(left, F.col("start")).otherwise(F.col("alt_end"))})
