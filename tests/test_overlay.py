"""Overlaid step functions against arrays of bases; neighbours and shifts over ranges against whole groups."""

import random
import re
import statistics

from junctura.operators import intervals as I
from junctura.operators import regions as R


def depth(reads, size):
    """Depth of every base by (sample, chrom), from M and D blocks."""
    out = {}
    for sample, chrom, start, cigar in reads:
        row = out.setdefault((sample, chrom), [0] * size)
        at = start
        for n, op in re.findall(r"(\d+)(\D)", cigar):
            n = int(n)
            if op in "MD":
                for i in range(at, at + n):
                    row[i] += 1
            at += n if op in "MDN" else 0
    return out


def test_overlay_equals_bases(spark):
    r, size = random.Random(1), 60_000
    reads = []
    for sample in ("a", "b", "c", "d"):
        for _ in range(150):
            chrom = r.choice(["chr1", "chr2"] if sample != "d" else ["chr2"])
            # far places too, so that depths are carried over many bins
            start = r.choice([r.randint(0, 400), r.randint(20_000, 20_300), r.randint(50_000, 50_100)])
            reads.append((sample, chrom, start, r.choice(["20M", "10M300N15M", "5M2D8M", "4S9M1I6M", "30M8000N7M"])))
    groups = [("x", "a"), ("x", "b"), ("x", "silent"), ("y", "a"), ("y", "b"), ("y", "c"), ("y", "d"), ("z", "silent"), ("x", "a")]
    d = spark.createDataFrame(reads, "sample string, chrom string, start int, cigar string")
    got = R.overlay(R.base_coverage(d, ("sample", "chrom")), spark.createDataFrame(groups, "group string, sample string")).collect()
    bases, none = depth(reads, size), [0] * size
    members = {g: sorted({s for x, s in groups if x == g}) for g, _ in groups}
    for g in members:
        for chrom in ("chr1", "chr2"):
            mean, median = [0.0] * size, [0.0] * size
            for x in got:
                if (x.group, x.chrom) == (g, chrom):
                    assert x.start < x.end
                    for i in range(x.start, x.end):
                        assert not mean[i]
                        mean[i], median[i] = x["mean"], x["median"]
            rows = [bases.get((s, chrom), none) for s in members[g]]
            assert all(abs(mean[i] - sum(x[i] for x in rows) / len(rows)) < 1e-9 for i in range(size))
            assert all(median[i] == statistics.median(x[i] for x in rows) for i in range(size))


def test_empty(spark):
    d = spark.createDataFrame([], "sample string, chrom string, start int, cigar string")
    assert R.overlay(R.base_coverage(d, ("sample", "chrom")), spark.createDataFrame([("x", "a")], "group string, sample string")).collect() == []


def test_neighbours_over_ranges(spark):
    r = random.Random(4)
    nodes = [(g, n, n * 10, n * 10 + r.randint(1, 9)) for g in "abc" for n in sorted(r.sample(range(500), r.choice([1, 2, 3, 60])))] + [("d", n, n * 10, n * 10 + 1) for n in range(300)]
    d = spark.createDataFrame(nodes, "gene string, node int, start int, end int")
    by = {g: [x for x in nodes if x[0] == g] for g in "abcd"}
    want, region = {}, {}
    for g, own in by.items():
        for i, (_, n, s, e) in enumerate(own):
            want[g, n] = own[i - 2][1] if i > 1 else None, own[i + 2][1] if i + 2 < len(own) else None
            lo, hi = own[max(0, i - 2)][2], own[min(len(own) - 1, i + 2)][3]
            region[g, n] = min(lo, hi), max(lo, hi)
    for width in (1, 7, 1_000):
        assert {(x.gene, x.node): (x.before, x.behind) for x in R.neighbours(d, 2, width).collect()} == want
        assert {(x.gene, x.node): (x["from"], x["to"]) for x in R.neighbourhood(d, 2, width).collect()} == region


def test_shrunken_introns_over_ranges(spark):
    r = random.Random(5)
    gaps = sorted((g, s, s + r.randint(1, 30_000)) for g in ("x", "y") for s in r.sample(range(900_000), 60))
    got = {(x.group, x.start, x.end): (x.new_start, x.new_end) for x in R.shrink(spark.createDataFrame(gaps, "group string, start int, end int")).collect()}
    for g in ("x", "y"):
        shift = 0
        for _, s, e in (x for x in gaps if x[0] == g):
            saved = (e - s) - int((e - s) ** 0.7)
            assert got[g, s, e] == (s - shift, e - shift - saved)
            shift += saved


def test_interval_joins_over_levels(spark):
    r = random.Random(6)
    lengths = [1, 5, 127, 128, 129, 1_025, 9_000, 70_000, 3_000_000]
    some = lambda n: [(r.choice("ab"), s, s + r.choice(lengths)) for s in (r.randint(0, 2_000) if r.random() < 0.7 else r.randint(0, 4_000_000) for _ in range(n))]
    left, right = some(150), some(150)
    l = spark.createDataFrame(left, "c string, start int, end int")  # noqa: E741
    x = spark.createDataFrame(right, "c string, r_start int, r_end int")
    got = sorted(map(tuple, I.overlaps(l, x, ["c"], 16).select("c", "start", "end", "r_start", "r_end").collect()))
    assert got == sorted((c, s, e, t, f) for c, s, e in left for d, t, f in right if c == d and s < f and t < e) and len(got) > 300
    inside = x.withColumnsRenamed({"r_start": "in_start", "r_end": "in_end"})
    got = sorted(map(tuple, I.contains(l, inside, ["c"]).select("c", "start", "end", "in_start", "in_end").collect()))
    assert got == sorted((c, s, e, t, f) for c, s, e in left for d, t, f in right if c == d and s <= t and f <= e) and len(got) > 100


def test_cigars_are_parsed_once(spark):
    reads = spark.createDataFrame([("a", "c", 0, "5M3N5M"), ("b", "c", 2, "4M"), ("b", "c", 2, None)], "sample string, chrom string, start int, cigar string")
    d = R.overlay(R.base_coverage(reads, ("sample", "chrom")), spark.createDataFrame([("g", "a"), ("g", "b")], "group string, sample string"))
    assert "regexp" not in d._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((x.start, x.end, x.total) for x in d.collect()) == [(0, 2, 1), (2, 5, 2), (5, 6, 1), (8, 13, 1)]
