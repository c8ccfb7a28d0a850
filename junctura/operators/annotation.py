"""Annotation side: transcripts to exons, introns and candidate microexons; junction tags; weight matrices.

Exons are rows (tx, block, chrom, strand, start, end).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence as S
from .genome import pieces, tiles, with_slices


def _by_tx():
    return Window.partitionBy("tx").orderBy("start", "block")


def bed12_exons(bed: DataFrame) -> DataFrame:
    blocks = bed.select("name", "chrom", "strand", "start", F.posexplode(F.arrays_zip("block_sizes", "block_starts")).alias("block", "b"))
    return blocks.select(F.col("name").alias("tx"), "block", "chrom", "strand", (F.col("start") + F.col("b.block_starts")).alias("start"), (F.col("start") + F.col("b.block_starts") + F.col("b.block_sizes")).alias("end"))


def exons_bed12(exons: DataFrame) -> DataFrame:
    """Transcripts as BED12 rows with comma lists, exons sorted by start."""
    tx = exons.groupBy("tx", "chrom", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("e"))
    first, last = F.get("e", 0)["start"], F.get("e", F.size("e") - 1)["end"]
    sizes = F.array_join(F.transform("e", lambda x: (x["end"] - x["start"]).cast("string")), ",")
    starts = F.array_join(F.transform("e", lambda x: (x["start"] - F.get("e", 0)["start"]).cast("string")), ",")
    return tx.select("chrom", first.alias("start"), last.alias("end"), F.col("tx").alias("name"), "strand", F.size("e").alias("block_count"), sizes.alias("block_sizes"), starts.alias("block_starts"))


def gtf_exons(features: DataFrame) -> DataFrame:
    e = features.where("feature = 'exon' and tx is not null")
    return e.withColumn("block", F.row_number().over(Window.partitionBy("tx").orderBy("start")) - 1).select("tx", "block", "chrom", "strand", "start", "end")


def introns(exons: DataFrame) -> DataFrame:
    """Gaps between neighbouring exons of a transcript."""
    nxt = F.lead("start").over(_by_tx())
    return exons.withColumn("next", nxt).where("next is not null").select("tx", "block", "chrom", "strand", F.col("end").alias("start"), F.col("next").alias("end"))


def triples(exons: DataFrame, max_len: int) -> DataFrame:
    """Internal exons of at most ``max_len`` with their host intron: candidate microexons."""
    d = exons.withColumns({"host_start": F.lag("end").over(_by_tx()), "host_end": F.lead("start").over(_by_tx())})
    return d.where((F.col("host_start").isNotNull()) & F.col("host_end").isNotNull() & (F.col("end") - F.col("start") <= max_len))


def internal(exons: DataFrame) -> DataFrame:
    """Exons that are neither first nor last."""
    d = exons.withColumns({"before": F.lag("start").over(_by_tx()), "after": F.lead("start").over(_by_tx())})
    return d.where("before is not null and after is not null").drop("before", "after")


def but_last(exons: DataFrame) -> DataFrame:
    """Exons that another one of their transcript follows."""
    return exons.withColumn("after", F.lead("start").over(_by_tx())).where("after is not null").drop("after")


def offsets(exons: DataFrame) -> DataFrame:
    """Each exon's end within its transcript."""
    return exons.withColumn("tx_end", F.sum(F.col("end") - F.col("start")).over(_by_tx().rowsBetween(Window.unboundedPreceding, 0)))


def previous_intron(gaps: DataFrame) -> DataFrame:
    return gaps.withColumns({"prev_start": F.lag("start").over(_by_tx()), "prev_end": F.lag("end").over(_by_tx())})


def transcript_sequences(exons: DataFrame, genome: DataFrame) -> DataFrame:
    """Spliced sequence of each transcript, as its strand reads it; transcripts of an unknown chromosome are left out."""
    rows, held = exons.select("tx", "strand", "chrom", "start", "end"), tiles(genome)
    parts = pieces(rows, held, F.col("start"), F.col("end")).select("tx", "strand", F.struct("start", "piece_at", "piece").alias("p"))
    # every sequence has a tile 0: a transcript without a base on a known chromosome is empty
    known = rows.join(held.where("tile = 0").select("chrom"), "chrom", "left_semi").select("tx", "strand")
    tx = parts.unionByName(known, allowMissingColumns=True).groupBy("tx", "strand").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return tx.select("tx", S.stranded(F.array_join(F.transform("p", lambda x: x["piece"]), ""), F.col("strand")).alias("seq"))


def exon_parts(exons: DataFrame, genome: DataFrame) -> DataFrame:
    """Exons with ``part``, their sequence on the plus strand."""
    return with_slices(exons, genome, {"part": (F.col("start"), F.col("end"))})


def flank_dinucleotides(exons: DataFrame, genome: DataFrame) -> DataFrame:
    """Exons with ``beside``: the two bases in front of and behind each, as its strand reads them; null where the two in front leave the chromosome."""
    d = with_slices(exons, genome, {"__up": (F.col("start") - 2, F.col("start")), "__down": (F.col("end"), F.col("end") + 2)})
    return d.select(*exons.columns, S.stranded(F.concat("__up", "__down"), F.col("strand")).alias("beside"))


def junction_tags(exons: DataFrame, sequences: DataFrame, flank: int) -> DataFrame:
    """Sequence of ``flank`` bases on both sides of each junction of a transcript, cut at its ends: (tx, junction, chrom, strand, start, end, up, tag)."""
    d = exons.withColumns({"next": F.lead("start").over(_by_tx()), "done": F.sum(F.col("end") - F.col("start")).over(_by_tx().rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum(F.col("end") - F.col("start")).over(Window.partitionBy("tx"))})
    d = d.where("next is not null").withColumn("at", F.when(F.col("strand") == "-", F.col("all") - F.col("done")).otherwise(F.col("done")))
    d = d.join(sequences, "tx").withColumn("up", F.least("at", F.lit(flank)))
    tag = F.substr("seq", (F.col("at") - F.col("up") + 1).cast("int"), (F.col("up") + F.least(F.col("all") - F.col("at"), F.lit(flank))).cast("int"))
    return d.select("tx", F.col("block").alias("junction"), "chrom", "strand", F.col("end").alias("start"), F.col("next").alias("end"), F.col("up").cast("long").alias("up"), tag.alias("tag"))


def eligible(exons: DataFrame, me_len: int, min_intron: int = 80) -> DataFrame:
    """Introns between two exons longer than a microexon, themselves at least ``min_intron`` long."""
    d = exons.withColumns({"next": F.lead("start").over(_by_tx()), "next_end": F.lead("end").over(_by_tx())})
    d = d.withColumns({"up_len": F.col("end") - F.col("start"), "down_len": F.col("next_end") - F.col("next")})
    return d.where((F.col("up_len") > me_len) & (F.col("down_len") > me_len) & (F.col("next") - F.col("end") >= min_intron)).select("tx", "block", "chrom", "strand", F.col("end").alias("start"), F.col("next").alias("end"), "up_len", "down_len")


def best_tags(tags: DataFrame) -> DataFrame:
    """For each intron the junction with the longest flanking exons; the first transcript wins ties."""
    by = Window.partitionBy("chrom", "strand", "start", "end").orderBy((F.col("up_len") + F.col("down_len")).desc(), "tx", "block")
    return tags.withColumn("rank", F.row_number().over(by)).where("rank = 1").drop("rank")


def insert_in_tag(tag, up, me):
    """A junction tag with a microexon between its flanks."""
    return F.concat(F.substr(tag, F.lit(1), up.cast("int")), me, F.substr(tag, (up + 1).cast("int")))


def annotated_mes(exons: DataFrame, genome: DataFrame, found: DataFrame, max_len: int) -> DataFrame:
    """Annotated exons of at most ``max_len`` between AG and GT, as their strand reads them, but those ``found`` has."""
    place = ["chrom", "strand", "start", "end"]
    short = exons.where((F.col("end") - F.col("start") <= max_len) & (F.col("start") >= 2)).select(*place).distinct().join(found.select(*place).distinct(), place, "left_anti")
    return flank_dinucleotides(short, genome).where("beside = 'AGGT'").select(*place)


def tags_of(mes: DataFrame, tags: DataFrame) -> DataFrame:
    """Each microexon with the tags of its junctions (comma list ``total_sjs``); a junction without a tag is left out."""
    return mes.select("me", F.explode(F.split("total_sjs", ",")).alias("sj")).join(tags, "sj")


def flank_pairs(gaps: DataFrame, ups: DataFrame, downs: DataFrame) -> DataFrame:
    """Introns with the flank known at their start (chrom, at, up) and at their end (chrom, at, down)."""
    return gaps.join(ups.withColumnRenamed("at", "start"), ["chrom", "start"]).join(downs.withColumnRenamed("at", "end"), ["chrom", "end"])


#: Bases of the splice sites' windows: the acceptor's in front of and inside the exon, the donor's inside and behind.  Fixed values.
ACCEPTOR, DONOR = (14, 3), (3, 10)


def splice_windows(places: DataFrame, genome: DataFrame) -> DataFrame:
    """Exons (chrom, strand, start, end) with ``acceptor``, 17 bases over their first border, and ``donor``, 13 over their last, as the strand reads them.

    A window is shorter where it leaves the chromosome behind, and empty where it leaves it in front.
    """
    minus, s, e = F.col("strand") == "-", F.col("start"), F.col("end")
    side = lambda plus, other: F.when(minus, other).otherwise(plus)
    (a_out, a_in), (d_in, d_out) = ACCEPTOR, DONOR
    windows = {"__a": (side(s - a_out, e - a_in), side(s + a_in, e + a_out)), "__d": (side(e - d_in, s - d_out), side(e + d_out, s + d_in))}
    read = lambda c: S.stranded(F.coalesce(c, F.lit("")), F.col("strand"))
    return with_slices(places, genome, windows).select(*places.columns, read("__a").alias("acceptor"), read("__d").alias("donor"))


def learn_matrices(exons: DataFrame, genome: DataFrame) -> DataFrame:
    """(site, pos, A, C, G, T): nucleotide shares around the internal exons of all transcripts that stand between AG and GT; letters other than the four do not count."""
    d = splice_windows(internal(exons).select("tx", "block", "chrom", "strand", "start", "end"), genome)
    d = d.where(F.concat(F.substring("donor", DONOR[0] + 1, 2), F.substring("acceptor", -ACCEPTOR[1] - 2, 2)) == "GTAG")
    both = F.explode(F.array(*(F.struct(F.lit(x).alias("site"), F.col(x).alias("w")) for x in ("acceptor", "donor")))).alias("x")
    at = d.select(both).select("x.site", F.posexplode(F.split("x.w", "")).alias("pos", "nt")).where(F.col("nt").isin(*"ACGT"))
    counts = at.groupBy("site", "pos").agg(F.count("*").alias("n"), *(F.count_if(F.col("nt") == x).alias(x) for x in "ACGT"))
    return counts.select("site", "pos", *((F.col(x) / F.col("n")).alias(x) for x in "ACGT"))


def collected(matrices: DataFrame) -> tuple[list[dict[str, float]], list[dict[str, float]]]:
    """The learned acceptor and donor matrices on the driver: as many rows as their windows have bases."""
    rows = matrices.orderBy("pos").collect()
    return tuple([{nt: r[nt] for nt in "ACGT"} for r in rows if r.site == site] for site in ("acceptor", "donor"))


def splice_scores(places: DataFrame, genome: DataFrame, acceptor: list[dict[str, float]], donor: list[dict[str, float]]) -> DataFrame:
    """Exons with ``u2``: what both windows reach of the two matrices' joint maximum, in percent.  Letters other than the four count 0."""
    most = S.pwm_best(acceptor) + S.pwm_best(donor)
    d = splice_windows(places, genome)
    total = S.pwm_sum(F.col("acceptor"), acceptor) + S.pwm_sum(F.col("donor"), donor)
    return d.select(*places.columns, (100 * total / most if most else F.lit(0.0)).alias("u2"))


def _spliced(parts: DataFrame) -> DataFrame:
    """Each exon beside its whole transcript ``seq``, with ``to``: the exon's end in it.  A transcript is joined once, whatever its number of exons."""
    ends = parts.withColumn("to", F.sum(F.length("part")).over(_by_tx().rowsBetween(Window.unboundedPreceding, 0)))
    rest = [c for c in ends.columns if c not in ("tx", "start", "block")]
    tx = ends.groupBy("tx").agg(F.array_sort(F.collect_list(F.struct("start", "block", *rest))).alias("e"))
    return tx.select("tx", "e", F.array_join(F.transform("e", lambda x: x["part"]), "").alias("seq"))


def running_flanks(exons: DataFrame, n: int = 100) -> DataFrame:
    """The last ``n`` transcript bases up to each exon's end (column ``part`` has each exon's sequence)."""
    cut = lambda x: F.struct(x["block"].alias("block"), F.substr(F.col("seq"), F.greatest(x["to"] - n, F.lit(0)).cast("int") + 1, F.least(x["to"], F.lit(n)).cast("int")).alias("flank"))
    return _spliced(exons).select("tx", F.inline(F.transform("e", cut)))


def first_transcript(rows: DataFrame, key: list[str]) -> DataFrame:
    """All transcripts of each key as a sorted list, and the first."""
    return rows.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set("tx")), ",").alias("transcripts"), F.min("tx").alias("tx"))


def me_tags(parts: DataFrame, n: int = 100) -> DataFrame:
    """Tag of each internal exon: the last ``n`` transcript bases before it, itself and the first ``n`` behind, as its strand reads them."""
    def tag(x):
        begin = F.greatest(x["to"] - F.length(x["part"]) - n, F.lit(0)).cast("int")
        text = F.substr(F.col("seq"), begin + 1, (x["to"] + n - begin).cast("int"))
        return F.struct(x["block"].alias("block"), S.stranded(text, x["strand"]).alias("tag"))

    inner = F.slice("e", F.lit(2), F.greatest(F.size("e") - 2, F.lit(0)))
    return _spliced(parts).select("tx", F.inline(F.transform(inner, tag)))
