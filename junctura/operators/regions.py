"""Region views: base coverage, junction counts, overlays, shrunken introns, neighbourhoods of nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..sources.shared import written
from .dealing import dealt
from .intervals import carried


def blocks_of(reads: DataFrame) -> DataFrame:
    """Reads (start, cigar) with their genomic blocks; exotic operations are left out."""
    return reads.where(~F.col("cigar").rlike("[HPX=]")).withColumn("blocks", C.exon_blocks(F.col("start"), C.parse(F.col("cigar"))))


def base_coverage(reads: DataFrame, by: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """(by, pos, depth) from block edges: +1 and -1 events and their running sum, one row for each place where the depth changes.

    With a column of samples in ``by`` each sample has its own.  The sums of events by place are a table in the shared folder, so each CIGAR is parsed once.
    """
    # of an outer generator no filter on its input is inferred, which would parse each CIGAR again
    b = blocks_of(reads).select(*by, F.explode_outer("blocks").alias("b")).where("b is not null")
    events = b.select(*by, F.explode(F.array(F.struct(F.col("b.start").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("b.end").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    sums = written(events.groupBy(*by, F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d")), "events")
    return _running(sums, by).where("d <> 0").select(*by, "pos", "depth")


def _running(events: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``depth``: the running sum of ``d`` by ``pos``."""
    here = Window.partitionBy(*by, "bin").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = carried(events, list(by), "pos", F.col("d"), F.sum)
    return d.withColumn("depth", F.coalesce("carried", F.lit(0)) + F.sum("d").over(here))


def junction_counts(reads: DataFrame) -> DataFrame:
    """(chrom, start, end, n): introns of split reads."""
    gaps = blocks_of(reads).select("chrom", F.explode(C.introns(F.col("blocks"))).alias("g"))
    return gaps.groupBy("chrom", F.col("g.start").alias("start"), F.col("g.end").alias("end")).agg(F.count("*").alias("n"))


def exon_counts(reads: DataFrame) -> DataFrame:
    """(chrom, start, end, n): internal blocks of reads with three or more."""
    inner = blocks_of(reads).where(F.size("blocks") >= 3).select("chrom", F.explode(F.slice("blocks", F.lit(2), F.size("blocks") - 2)).alias("b"))
    return inner.groupBy("chrom", F.col("b.start").alias("start"), F.col("b.end").alias("end")).agg(F.count("*").alias("n"))


def overlay(coverage: DataFrame, samples: DataFrame) -> DataFrame:
    """Step functions of a group's samples laid over each other: (group, chrom, start, end, mean, median, total), a row for each stretch between two breakpoints of any.

    ``coverage`` (sample, chrom, pos, depth) as :func:`base_coverage` gives it, ``samples`` (group, sample) all members of each group.  A sample has depth 0 in front
    of its first breakpoint, behind its last, and everywhere if it has no reads; every base of a stretch then has the same depths, so that mean and median are those of
    base-by-base arrays.  Stretches where no sample has reads are left out; a base-weighted mean over a region is sum(mean * (end - start)) over its length.
    """
    members = samples.select("group", "sample").distinct()
    own = written(members.join(coverage, "sample").select("group", "sample", "chrom", F.col("pos").cast("long").alias("pos"), "depth"), "depths")
    # each breakpoint of a group comes to all its members
    marks = own.select("group", "chrom", "pos").distinct().join(members, "group")
    d = marks.join(own, ["group", "sample", "chrom", "pos"], "left").withColumn("held", F.when(F.col("depth").isNotNull(), F.struct("pos", "depth")))
    d = carried(d, ["group", "sample", "chrom"], "pos", F.col("held"), F.max)
    upto = Window.partitionBy("group", "sample", "chrom", "bin").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    now = F.greatest("carried", F.max("held").over(upto))
    d = d.select("group", "chrom", "bin", "pos", F.coalesce(now["depth"], F.lit(0)).alias("depth"))
    at = d.groupBy("group", "chrom", "bin", "pos").agg(F.avg("depth").alias("mean"), F.percentile("depth", 0.5).alias("median"), F.sum("depth").alias("total"))
    # the next breakpoint is in this bin or the first of a later one
    later = carried(at.drop("bin"), ["group", "chrom"], "pos", F.col("pos"), F.min, later=True)
    end = F.coalesce(F.lead("pos").over(Window.partitionBy("group", "chrom", "bin").orderBy("pos")), "carried")
    return later.withColumn("end", end).where("total > 0").select("group", "chrom", F.col("pos").alias("start"), "end", "mean", "median", "total")


def merge_junctions(j: DataFrame) -> DataFrame:
    """Junctions of several samples at one place: largest ends, summed counts, joined labels."""
    return j.groupBy("x", "xend").agg(F.max("y").alias("y"), F.max("yend").alias("yend"), F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_list("label")), ",").alias("labels"))


def intersect_runs(gaps: DataFrame, parts: int | None = None) -> DataFrame:
    """Overlapping introns of a group reduced to their common part: a fold over the sorted list that starts anew where an intron does not touch the common part.

    Where an intron starts behind the end of all before it a new run begins in any case; the fold is done for each such island.
    """
    d = dealt(gaps.select("group", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")), parts, "group", "start", "end").distinct()
    by = Window.partitionBy("group", "bin").orderBy("start", "end")
    before, upto = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(Window.unboundedPreceding, 0)
    d = carried(d, ["group"], "start", F.col("end"), F.max, parts=parts).withColumn("reach", F.greatest("carried", F.max("end").over(before)))
    d = d.withColumn("head", F.when(F.col("reach").isNull() | (F.col("start") >= F.col("reach")), F.col("start"))).drop("bin", "carried", "reach")
    d = carried(d, ["group"], "start", F.col("head"), F.max, parts=parts).withColumn("island", F.greatest("carried", F.max("head").over(upto)))
    kind = "struct<done:array<struct<start:int,end:int>>,start:int,end:int>"
    islands = dealt(d.select("group", "island", "start", "end"), parts, "group", "island").groupBy("group", "island").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("g"))
    first = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"), F.get("g", 0)["start"].alias("start"), F.get("g", 0)["end"].alias("end")).cast(kind)
    pair = lambda a: F.array(F.struct(a["start"].alias("start"), a["end"].alias("end")))

    def step(a, x):
        inside = F.struct(a["done"].alias("done"), F.greatest(a["start"], x["start"]).alias("start"), F.least(a["end"], x["end"]).alias("end"))
        fresh = F.struct(F.concat(a["done"], pair(a)).alias("done"), x["start"].alias("start"), x["end"].alias("end"))
        return F.when(x["start"] < a["end"], inside).otherwise(fresh).cast(kind)

    runs = F.aggregate(F.slice("g", F.lit(2), F.greatest(F.size("g") - 1, F.lit(0))), first, step, lambda a: F.concat(a["done"], pair(a)))
    return islands.select("group", F.explode(runs).alias("r")).select("group", "r.start", "r.end")


def shrink(gaps: DataFrame, power: float = 0.7) -> DataFrame:
    """New places of introns whose length l becomes l**power: the shift so far is a running sum, over ranges of a group and then within each.

    Introns of a group that start at one place follow each other by their ends.
    """
    d = gaps.withColumn("saved", (F.col("end") - F.col("start")) - F.floor(F.pow(F.col("end") - F.col("start"), F.lit(power))))
    d = carried(d, ["group"], "start", F.col("saved"), F.sum)
    here = F.sum("saved").over(Window.partitionBy("group", "bin").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("shift", F.coalesce("carried", F.lit(0)) + F.coalesce(here, F.lit(0)))
    return d.select("group", "start", "end", (F.col("start") - F.col("shift")).cast("long").alias("new_start"), (F.col("end") - F.col("shift") - F.col("saved")).cast("long").alias("new_end"))


def _bordered(nodes: DataFrame, reach: int, width: int) -> DataFrame:
    """Nodes (gene, node, start, end, own) dealt by ranges of ``width`` numbers (``bin``); each range also holds the last ``reach`` nodes of its gene in front of it and
    the first behind it, not its own.  Only one row a range passes the gene's task."""
    d = nodes.select("gene", "node", "start", "end", F.floor(F.col("node") / width).alias("bin")).repartition("gene", "bin")
    ends = d.groupBy("gene", "bin").agg(F.array_sort(F.collect_list(F.struct("node", "start", "end"))).alias("own"))
    ends = ends.select("gene", "bin", F.slice("own", 1, reach).alias("first"), F.slice(F.reverse("own"), 1, reach).alias("last"))
    by, names = Window.partitionBy("gene").orderBy("bin"), []
    for c, step in (("last", F.lag), ("first", F.lead)):
        for i in range(1, reach + 1):
            names.append(f"{c}{i}")
            ends = ends.withColumn(names[-1], step(c, i).over(by))
    near = lambda c: F.slice(F.flatten(F.filter(F.array(*(x for x in names if x.startswith(c))), lambda x: x.isNotNull())), 1, reach)
    borders = ends.select("gene", "bin", F.inline(F.concat(near("last"), near("first"))), F.lit(False).alias("own"))
    return d.withColumn("own", F.lit(True)).unionByName(borders)


def neighbours(nodes: DataFrame, reach: int = 2, width: int = 1 << 12) -> DataFrame:
    """(gene, node, before, behind): the nodes ``reach`` places in front of and behind each in its gene; null where there are fewer."""
    w = Window.partitionBy("gene", "bin").orderBy("node")
    d = _bordered(nodes, reach, width).withColumns({"before": F.lag("node", reach).over(w), "behind": F.lead("node", reach).over(w)})
    return d.where("own").select("gene", "node", "before", "behind")


def neighbourhood(nodes: DataFrame, reach: int = 2, width: int = 1 << 12) -> DataFrame:
    """Region from the node ``reach`` before to that ``reach`` behind it in its gene, or as far as there are any."""
    w = Window.partitionBy("gene", "bin").orderBy("node")
    lo = F.coalesce(*(F.lag("start", i).over(w) for i in range(reach, 0, -1)), "start")
    hi = F.coalesce(*(F.lead("end", i).over(w) for i in range(reach, 0, -1)), "end")
    d = _bordered(nodes, reach, width).withColumns({"lo": lo, "hi": hi}).where("own")
    return d.select("gene", "node", F.least("lo", "hi").alias("from"), F.greatest("lo", "hi").alias("to"))
