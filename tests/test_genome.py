"""Tiled genomes against whole strings; splice scores against loops."""

import random

import pytest
from pyspark.sql import functions as F

from junctura.operators import annotation as A
from junctura.operators import genome as G
from junctura.plans import pipeline as P
from junctura.sources import bigwig as W
from junctura.sources import text as IO

COMP = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s.translate(COMP)[::-1]


def genome_of(seed=1):
    r = random.Random(seed)
    return {f"chr{i}": "".join(r.choices("ACGT", k=n)) for i, n in enumerate([0, 1, 63, 64, 65, 700, 5_000])}


@pytest.mark.parametrize("split", [200, 1_000, 1 << 20])
def test_tiles_from_lines(spark, tmp_path, split):
    seqs = genome_of()
    text = "".join(f">{c} about > this\n" + "".join(s[i : i + 61].lower() + ("\r\n" if i % 3 else "\n") for i in range(0, len(s), 61)) + "\n" for c, s in seqs.items())
    (tmp_path / "a.fa").write_text(text)
    (tmp_path / "b.fa").write_text(">other\nNNAC\n\nGT")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = {(x.chrom, x.tile): x.seq for x in IO.fasta_tiles(spark, str(tmp_path), 64).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {(c, t): s[64 * t : 64 * t + 64] for c, s in (seqs | {"other": "NNACGT"}).items() for t in range(max(1, -(-len(s) // 64)))}
    assert got == want
    whole = spark.createDataFrame(list(seqs.items()), "id string, seq string")
    assert {(x.chrom, x.tile): x.seq for x in G.tiles(whole, 64).collect()} == {k: v for k, v in want.items() if k[0] != "other"}
    assert {x.chrom: x["size"] for x in IO.chrom_sizes(G.tiles(whole, 64)).collect()} == {c: len(s) for c, s in seqs.items()}


def test_slices(spark):
    seqs, r = genome_of(), random.Random(2)
    rows = [(c, s, s + r.choice([0, 1, 5, 63, 64, 65, 300, 6_000]), r.randint(0, 9)) for c in seqs for s in r.sample(range(-3, 5_100), 30)]
    rows += [("chrX", 3, 9, 1), ("chr6", 100, 50, 1)] + rows[5:9] * 2
    d = spark.createDataFrame(rows, "chrom string, start int, end int, tag int")
    tiles = G.tiles(spark.createDataFrame(list(seqs.items()), "id string, seq string"), 64)
    got = G.with_slices(d, tiles, {"all": (F.col("start"), F.col("end")), "near": (F.col("end") - 2, F.col("end") + 3)}, 64).collect()
    cut = lambda c, a, b: None if a < 0 else seqs.get(c, "")[a : max(a, b)]
    assert sorted(map(str, ((x.chrom, x.start, x.end, x.tag, x["all"], x.near) for x in got))) == sorted(str((c, s, e, t, cut(c, s, e), cut(c, e - 2, e + 3))) for c, s, e, t in rows)
    parts = G.pieces(d, tiles, F.col("start"), F.col("end"), 64)
    joined = parts.distinct().groupBy("chrom", "start", "end", "tag").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_at", "piece"))), lambda x: x["piece"]), "").alias("s")).collect()
    assert {(x.chrom, x.start, x.end, x.tag): x.s for x in joined} == {(c, s, e, t): seqs[c][max(s, 0) : e] for c, s, e, t in rows if c in seqs and seqs[c][max(s, 0) : max(e, 0)]}
    assert parts.where(F.length("piece") > 64).count() == 0


def windows(g, chrom, strand, s, e):
    """The two windows of an exon as slices of a string; what starts in front of it is empty."""
    cut = lambda a, b: g.get(chrom, "")[a:b] if a >= 0 else ""
    if strand == "-":
        return rc(cut(e - 3, e + 14)), rc(cut(s - 10, s + 3))
    return cut(s - 14, s + 3), cut(e - 3, e + 10)


def brute(g, exons):
    """Both learned matrices and the score of every exon."""
    count = {"acceptor": {}, "donor": {}}
    inner = [x for tx in {x[0] for x in exons} for x in sorted((y for y in exons if y[0] == tx), key=lambda y: y[4])[1:-1]]
    for _, _, chrom, strand, s, e in inner:
        a, d = windows(g, chrom, strand, s, e)
        if d[3:5] + a[-5:-3] == "GTAG":
            for site, w in (("acceptor", a), ("donor", d)):
                for i, nt in enumerate(w):
                    if nt in "ACGT":
                        count[site].setdefault(i, dict.fromkeys("ACGT", 0))[nt] += 1
    matrix = {site: [{nt: n / sum(row.values()) for nt, n in row.items()} for _, row in sorted(rows.items())] for site, rows in count.items()}
    best = sum(max(row.values()) for rows in matrix.values() for row in rows)

    def score(chrom, strand, s, e):
        return 100 * sum(rows[i].get(nt, 0) for rows, w in zip((matrix["acceptor"], matrix["donor"]), windows(g, chrom, strand, s, e)) for i, nt in enumerate(w)) / best

    return matrix, score


def annotation():
    r = random.Random(5)
    g = {c: list("".join(r.choices("ACGTN", weights=[9, 9, 9, 9, 1], k=9_000))) for c in ("chr1", "chr_2")}
    exons = []
    for tx in range(60):
        chrom, strand, at = r.choice(list(g)), r.choice("+-"), r.randint(0, 6_000)
        for block in range(r.randint(1, 7)):
            s, e = at, at + r.randint(3, 60)
            exons.append((tx, block, chrom, strand, s, e))
            if r.random() < 0.6 and s >= 2:  # sites as most exons have them
                left, right = ("AG", "GT") if strand == "+" else ("AC", "CT")
                g[chrom][s - 2 : s], g[chrom][e : e + 2] = left, right
            at = e + r.randint(20, 400)
    exons += [(90, 0, "chr1", "+", 0, 5), (90, 1, "chr1", "+", 8, 12), (90, 2, "chr1", "+", 8_990, 8_998), (90, 3, "chr1", "+", 8_999, 9_000), (91, 0, "gone", "+", 5, 9), (91, 1, "gone", "+", 50, 90), (91, 2, "gone", "+", 500, 900)]
    return {c: "".join(s) for c, s in g.items()}, exons


def test_splice_scores(spark):
    g, exons = annotation()
    matrix, score = brute(g, exons)
    e = spark.createDataFrame(exons, "tx int, block int, chrom string, strand string, start int, end int")
    genome = spark.createDataFrame(list(g.items()), "id string, seq string")
    acceptor, donor = A.collected(A.learn_matrices(e, genome))
    for got, want in ((acceptor, matrix["acceptor"]), (donor, matrix["donor"])):
        assert len(got) == len(want) and all(abs(a[nt] - b[nt]) < 1e-12 for a, b in zip(got, want) for nt in "ACGT")
    assert (len(acceptor), len(donor)) == (17, 13)
    rows = A.splice_scores(e, genome, acceptor, donor).collect()
    assert len(rows) == len(exons) and all(abs(x.u2 - score(x.chrom, x.strand, x.start, x.end)) < 1e-9 for x in rows)
    nothing = A.collected(A.learn_matrices(e.limit(0), genome))
    assert nothing == ([], []) and {x.u2 for x in A.splice_scores(e, genome, *nothing).collect()} == {0.0}


def test_microexon_scores(spark, tmp_path):
    g, exons = annotation()
    _, score = brute(g, exons)
    e = spark.createDataFrame(exons, "tx int, block int, chrom string, strand string, start int, end int")
    genome = spark.createDataFrame(list(g.items()), "id string, seq string")
    path = f"file://{tmp_path}/bw"
    W.write_bigwig(spark.createDataFrame([("chr1", 0, 9_000, 2.0), ("chr_2", 0, 100, 1.0)], "chrom string, start int, end int, value double"), spark.createDataFrame([(c, len(s)) for c, s in g.items()], "chrom string, size long"), path)
    mes = [("chr1", "+", 500, 512), ("chr_2", "-", 90, 101), ("chr_2", "+", 4_000, 4_009)]
    found = spark.createDataFrame([(f"{c}_{x}_{s}_{t}",) for c, x, s, t in mes] * 2, "me string")
    got = {x.me: (x.u2, x.cons) for x in P.microexon_scores(found, genome, *P.splice_matrices(e, genome), path).collect()}
    cons = [2.0, 1.0, 0.0]
    assert len(got) == 3
    for (c, x, s, t), k in zip(mes, cons):
        u2, own = got[f"{c}_{x}_{s}_{t}"]
        assert abs(u2 - score(c, x, s, t)) < 1e-9 and abs(own - k) < 1e-9
    assert {x.cons for x in P.microexon_scores(found, genome, *P.splice_matrices(e, genome)).collect()} == {0.0}


def test_slices_are_cut_once(spark):
    """Of rows with equal windows only one brings its bases to an exchange."""
    rows = spark.range(20_000).select(F.lit("chr1").alias("chrom"), F.col("id").alias("tag"), (F.col("id") % 3 * 100).alias("start"))
    genome = spark.createDataFrame([("chr1", "".join(random.Random(3).choices("ACGT", k=3_000)))], "id string, seq string")
    got = G.with_slices(rows, genome, {"cut": (F.col("start"), F.col("start") + 2_000)}, 1_024)
    assert got.groupBy("cut").count().count() == 3 and got.count() == 20_000
    assert got.where(F.length("cut") != 2_000).isEmpty()
    # no grouping is by row: the rows' own column is no key of one
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and not any("tag" in line for line in plan.splitlines() if "Aggregate" in line)


def test_slices_without_bounds(spark):
    rows = spark.createDataFrame([("chr1", 1, None), ("chr1", None, 3), ("chr1", 1, 3), (None, 1, 3)], "chrom string, start int, end int")
    genome = spark.createDataFrame([("chr1", "ACGT")], "id string, seq string")
    got = G.with_slices(rows, genome, {"cut": (F.col("start"), F.col("end"))}, 2).collect()
    assert {(r.chrom, r.start, r.end): r.cut for r in got} == {("chr1", 1, None): None, ("chr1", None, 3): None, ("chr1", 1, 3): "CG", (None, 1, 3): ""}
