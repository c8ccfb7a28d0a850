"""Interval joins by bins: hot chromosomes are spread over bins, and each pair is found once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dealing import dealt


#: Bins of a level are so many times as wide as those of the one below it.
_STEP, _WIDEST = 8, 1 << 28


def _widths(width: int) -> list[int]:
    """Bin widths by level, from ``width`` up to more than a chromosome has."""
    out = [width]
    while out[-1] < _WIDEST:
        out.append(out[-1] * _STEP)
    return out


def _own_bins(start: Column, end: Column, widths: list[int]) -> Column:
    """(level, bin) of an interval, at the level whose bins are about as wide as it is long: nine bins at most."""
    length = F.greatest(end - start, F.lit(1))
    at = lambda i, w: F.transform(F.sequence(F.floor(start / w), F.floor(F.greatest(end - 1, start) / w)), lambda b: F.struct(F.lit(i).alias("level"), b.alias("bin")))
    out = at(len(widths) - 1, widths[-1])
    for i, w in reversed(list(enumerate(widths[:-1]))):
        out = F.when(length <= w * _STEP, at(i, w)).otherwise(out)
    return out


def _width_of(widths: list[int]) -> Column:
    return F.element_at(F.array(*map(F.lit, widths)), F.col("level") + 1)


def contains(outer: DataFrame, inner: DataFrame, on: list[str], width: int = 128) -> DataFrame:
    """Pairs of an outer interval (start, end) and an inner one (in_start, in_end) inside it with equal ``on`` columns.

    Bins form levels of rising width.  An outer interval lies in the few bins that it touches at the level of its own length, so that long ones take no more bins than
    short ones and a deep locus is spread over levels; an inner one asks in the bin of its start at each level, so no pair comes twice.
    """
    widths = _widths(width)
    o = outer.select("*", F.inline(_own_bins(F.col("start"), F.col("end"), widths)))
    asked = F.array(*(F.struct(F.lit(i).alias("level"), F.floor(F.col("in_start") / w).alias("bin")) for i, w in enumerate(widths)))
    return o.join(inner.select("*", F.inline(asked)), [*on, "level", "bin"]).where("start <= in_start and in_end <= end").drop("level", "bin")


def overlaps(left: DataFrame, right: DataFrame, on: list[str], width: int = 128) -> DataFrame:
    """Pairs of intervals (start, end) and (r_start, r_end) that share a base, with equal ``on`` columns.

    A right interval lies in the bins of its own level, a left one asks in those that it touches at each; a pair counts in the bin where its common part begins.
    """
    widths = _widths(width)
    r = right.select("*", F.inline(_own_bins(F.col("r_start"), F.col("r_end"), widths)))
    touched = lambda i, w: F.transform(F.sequence(F.floor(F.col("start") / w), F.floor(F.greatest(F.col("end") - 1, F.col("start")) / w)), lambda b: F.struct(F.lit(i).alias("level"), b.alias("bin")))
    both = left.select("*", F.inline(F.concat(*(touched(i, w) for i, w in enumerate(widths))))).join(r, [*on, "level", "bin"])
    both = both.where("start < r_end and r_start < end")
    return both.where(F.col("bin") == F.floor(F.greatest("start", "r_start") / _width_of(widths))).drop("level", "bin")


def mean_value(regions: DataFrame, values: DataFrame, ident: list[str], flank: int = 2, width: int = 128) -> DataFrame:
    """Base-weighted mean of interval values over each region widened by ``flank``; null where nothing is known.

    ``width`` is that of the join's bins, of the order of the intervals' length.
    """
    wide = regions.select(*ident, "chrom", (F.col("start") - flank).alias("start"), (F.col("end") + flank).alias("end"))
    hit = overlaps(wide, values.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), "value"), ["chrom"], width)
    bases = F.least("end", "r_end") - F.greatest("start", "r_start")
    means = hit.withColumn("bases", bases).groupBy(*ident).agg((F.sum(F.col("value") * F.col("bases")) / F.sum("bases")).alias("mean"))
    return regions.select(*ident).distinct().join(means, ident, "left")


def carried(rows: DataFrame, group: list[str], at: str, value: Column, agg, width: float = 1 << 14, later: bool = False, parts: int | None = None) -> DataFrame:
    """``rows`` with ``bin`` (of ``at``) and ``carried``: ``agg`` of ``value`` over all earlier bins of the group (or ``later`` ones), null where there is none.

    A running aggregate over a whole chromosome is then a window over (group, bin) on top of ``carried``; only one row a bin passes the chromosome's task.
    The rows are dealt by group and bin once, for the bins' sums, the join and windows over both; into ``parts``, or for None as many as the session has.
    """
    d = rows.withColumn("bin", F.floor(F.col(at) / width))
    d = d.repartition(*group, "bin") if parts is None else dealt(d, parts, *group, "bin")
    before = Window.partitionBy(*group).orderBy("bin")
    before = before.rowsBetween(1, Window.unboundedFollowing) if later else before.rowsBetween(Window.unboundedPreceding, -1)
    bins = dealt(d.groupBy(*group, "bin").agg(agg(value).alias("own")), parts, *group).withColumn("carried", agg(F.col("own")).over(before)).drop("own")
    return d.join(bins, [*group, "bin"])


def interpolate(points: DataFrame, at: DataFrame, group: list[str], width: float = 1.0) -> DataFrame:
    """``at`` (group columns, x, others) with ``y`` on the line between the two points (group columns, x, y) beside it.

    Points of one place are averaged; a place of a point has its value; outside the points, and for a null x, y is null.  Bins of ``width`` spread a group.
    """
    known = points.where("x is not null and y is not null").groupBy(*group, "x").agg(F.avg("y").alias("y")).withColumn("known", F.lit(True))
    rows = at.drop("y").withColumn("known", F.lit(False)).unionByName(known, allowMissingColumns=True)
    point = F.when(F.col("known"), F.struct("x", "y"))
    d = carried(rows, group, "x", point, F.max, width).withColumnRenamed("carried", "below")
    d = carried(d.drop("bin"), group, "x", point, F.min, width, True).withColumnRenamed("carried", "above")
    by = Window.partitionBy(*group, "bin").orderBy("x")
    lo = F.greatest("below", F.max(point).over(by.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    hi = F.least("above", F.min(point).over(by.rangeBetween(Window.currentRow, Window.unboundedFollowing)))
    d = d.withColumns({"lo": lo, "hi": hi}).where("not known")
    line = F.col("lo.y") + (F.col("hi.y") - F.col("lo.y")) * (F.col("x") - F.col("lo.x")) / (F.col("hi.x") - F.col("lo.x"))
    y = F.when(F.col("lo.x") == F.col("hi.x"), F.col("lo.y")).when(F.col("lo.x").isNotNull() & F.col("hi.x").isNotNull(), line)
    found = d.where("x is not null").withColumn("y", y).select(*at.drop("y").columns, "y")
    return found.unionByName(at.where("x is null").drop("y").withColumn("y", F.lit(None).cast("double")))
