"""Discovery, quantification and comparison as compositions of the operators.  A sample is a column, so per-sample work is data parallel."""

from __future__ import annotations

from dataclasses import dataclass

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
from ..operators import genome as G
from ..sources import bigwig as W


@dataclass(frozen=True)
class Settings:
    """The knobs of a run and their usual values."""

    me_len: int = 30
    max_read_len: int = 100
    min_reads_psi: int = 5
    min_conservation: float = 2.0
    min_samples: int = 2
    skip_mixture: bool = False
    seed: int = 123


def tag_library(exons: DataFrame, genome: DataFrame, s: Settings) -> DataFrame:
    """One junction tag for each intron of eligible size and canonical ends: (id, seq, up, chrom, strand, start, end)."""
    tags = A.junction_tags(exons, A.transcript_sequences(exons, genome), s.max_read_len)
    best = A.best_tags(A.eligible(exons, s.me_len)).select("tx", F.col("block").alias("junction"))
    d = G.with_slices(tags.join(best, ["tx", "junction"]), genome, {"between": (F.col("start"), F.col("end"))})
    intron = S.stranded(F.col("between"), F.col("strand"))
    d = d.where(S.canonical(S.splice_dinucleotides(intron)))
    return d.select(K.sj_id(F.col("chrom"), F.col("strand"), F.col("start"), F.col("end")).alias("id"), F.col("tag").alias("seq"), "up", "chrom", "strand", "start", "end", intron.alias("intron_seq"))


def discover(hits: DataFrame, tags: DataFrame, s: Settings) -> DataFrame:
    """Candidate microexons of reads with an insertion at a junction: hits (read, tag, start, cigar, seq) to (read, sj, me_seq, me, seq)."""
    d = X.one_insertion(hits).join(tags.select(F.col("id").alias("tag"), F.col("seq").alias("tag_seq"), F.col("up").alias("t_up"), "chrom", "strand", F.col("start").alias("i_start"), F.col("end").alias("i_end"), "intron_seq"), "tag")
    d = d.drop("up").withColumnRenamed("t_up", "up").withColumn("found", F.substr("seq", (F.col("ins_at") + 1).cast("int"), F.col("ins_len")))
    up, down = F.substr("tag_seq", F.lit(1), F.col("up").cast("int")), F.substr("tag_seq", (F.col("up") + 1).cast("int"))
    # the insertion's place in the tag
    d = d.withColumns({"dru": S.direct_repeat_up(up, F.col("found")), "drd": S.direct_repeat_down(down, F.col("found")), "at_tag": F.col("start") + F.col("ins_at")})
    d = d.withColumn("read_at", F.col("ins_at")).withColumn("ins_at", F.col("at_tag"))
    d = X.read_filter(X.in_repeat_window(d), s.me_len)
    moved = X.reanchor(F.col("found"), F.col("read_at") + F.col("up") - F.col("ins_at"), F.col("ins_at"), F.col("seq"))
    d = d.withColumn("me_seq", moved)
    hit = X.candidates(d.select("read", "tag", "me_seq", "intron_seq", "seq", "chrom", "strand", "i_start", "i_end"))
    n = F.length("me_seq")
    start = F.when(F.col("strand") == "-", F.col("i_end") - F.col("at") - n).otherwise(F.col("i_start") + F.col("at"))
    return hit.withColumns({"start": start, "end": start + n}).select("read", F.col("tag").alias("sj"), "me_seq", K.me_id(F.col("chrom"), F.col("strand"), F.col("start"), F.col("end")).alias("me"), "seq", (F.col("i_end") - F.col("i_start")).alias("intron_len"))


def splice_matrices(exons: DataFrame, genome: DataFrame) -> tuple[list[dict[str, float]], list[dict[str, float]]]:
    """The acceptor and donor matrices that an annotation's own exons give."""
    return A.collected(A.learn_matrices(exons, genome))


def microexon_scores(found: DataFrame, genome: DataFrame, acceptor: list[dict[str, float]], donor: list[dict[str, float]], conservation: str | None = None, flank: int = 2) -> DataFrame:
    """(me, u2, cons) of the microexons of discovered rows: their splice score, and the mean of a bigWig file over them widened by ``flank``, 0 without a file."""
    part = lambda i: F.regexp_extract("me", r"^(.*)_([+-])_(\d+)_(\d+)$", i)
    places = found.select("me").distinct().where(part(2) != "").select("me", part(1).alias("chrom"), part(2).alias("strand"), part(3).cast("int").alias("start"), part(4).cast("int").alias("end"))
    known = W.conservation(found.sparkSession, places, conservation, ["me"], flank)
    return A.splice_scores(places, genome, acceptor, donor).select("me", "u2").join(known.withColumnRenamed("mean", "cons"), "me")


def microexon_table(found: DataFrame, scores: DataFrame) -> DataFrame:
    """The microexon table: coverage by junction and sequence, common candidates and the best of them; ``scores`` (me, u2, cons)."""
    key = F.concat_ws("_", "sj", "me_seq")
    rows = found.withColumn("key", key).join(scores, "me", "left").na.fill(0.0, ["u2", "cons"])
    by = rows.groupBy("key").agg(F.countDistinct("seq").alias("coverage"), F.min(S.spurious_denovo(F.length("me_seq"), F.col("intron_len"))).alias("p_spurious"), F.array_sort(F.collect_set(F.struct("me", "u2", "cons"))).alias("candidates"))
    return X.centric(by)


def quantify(reads: DataFrame, tags: DataFrame, s: Settings) -> DataFrame:
    """Inclusion by sample: reads (sample, tag, start, matched, seq, flag, cigar) on tags (tag, sj, me or null, up, me_len or null)."""
    d = Q.anchored(Q.ungapped(reads.join(tags, "tag")))
    counts = d.groupBy("sample", "sj").agg(F.count_if(F.col("me").isNull()).alias("skip"))
    inside = d.where("me is not null").groupBy("sample", "me", "sj").agg(F.count("*").alias("inc"))
    pairs = tags.where("me is not null").select("me", "sj").distinct()
    full = pairs.join(counts.select("sample", "sj").unionByName(inside.select("sample", "sj")).distinct(), "sj")
    cov = full.join(inside, ["sample", "me", "sj"], "left").join(counts, ["sample", "sj"], "left").na.fill(0, ["inc", "skip"])
    return Q.psi(cov.groupBy("sample", "me").agg(F.sum("inc").alias("inc"), F.sum("skip").alias("skip")), s.min_reads_psi)


def final_filter(table: DataFrame, n_samples: DataFrame, s: Settings) -> DataFrame:
    """P-values and classes of the microexon table; with the mixture skipped, or too few lengths to set a threshold, all are IN without P-value."""
    d = L.detected(table, n_samples, s.min_samples)
    if not s.skip_mixture:
        fit = N.mixture(d, "u2").first()
        if fit is not None:
            p = N.p_value(N.posterior(F.col("u2"), *fit), F.col("p_me"), F.col("n_matches"))
            d = d.withColumn("p", p)
            best = L.best_threshold(L.residual_sigma(L.length_histogram(d.where("not short and p is not null")))).first()
            if best is not None and best["threshold"] is not None:
                return d.withColumn("me_type", L.classify(F.col("p"), best["threshold"], F.col("cons"), s.min_conservation))
    return d.withColumns({"p": F.lit(None).cast("double"), "me_type": F.lit("IN")})


def differential(diff: DataFrame, exons: DataFrame, high: DataFrame) -> DataFrame:
    """Differential nodes (gene, node, chrom, strand, n_start, n_end, type, ...) that stand for high-quality microexons (exon_id)."""
    named = D.node_exons(exons).select("gene", "node", F.regexp_extract("exon", r":(\d+)-", 1).cast("int").alias("x_start"), F.regexp_extract("exon", r"-(\d+):", 1).cast("int").alias("x_end"))
    return D.exon_of_node(diff.join(named, ["gene", "node"], "left")).join(high.select("exon_id"), "exon_id", "left_semi")


def single_cell(replicates: DataFrame, cdf_t: float = 0.5, min_delta: float = 0.1, min_p: float = 0.5, min_rep: int = 3) -> DataFrame:
    """Replicate statistics of pooled cells with the significance of each node."""
    return D.significant(D.replicate_stats(replicates), cdf_t, min_delta, min_p, min_rep)


__all__ = ["Settings", "differential", "discover", "final_filter", "microexon_scores", "microexon_table", "quantify", "single_cell", "splice_matrices", "tag_library"]
