"""A synthetic genome with planted microexons, end to end; and the registered queries."""

import random
import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from junctura.functions import sequence as S
from junctura.operators import align, isoforms, regions
from junctura.operators import discovery as X
from junctura.plans import pipeline as P


@pytest.fixture(scope="module")
def world(spark):
    r = random.Random(11)
    rand = lambda n: "".join(r.choices("ACGT", k=n))
    me = "CCATTGCAT"
    intron = "GT" + rand(60) + "AG" + me + "GT" + rand(60) + "AG"
    left, right = rand(120), rand(120)
    plus = left + intron + right
    genome = spark.createDataFrame([("chr_1", rand(50) + plus + rand(50)), ("chr2", S_rc(rand(50) + plus + rand(50)))], "id string, seq string")
    n = len(genome.where("id = 'chr2'").first().seq)
    ex = [("t1", 0, "chr_1", "+", 50, 170), ("t1", 1, "chr_1", "+", 170 + len(intron), 290 + len(intron))]
    flip = [("t2", 1 - b, "chr2", "-", n - e, n - s) for _, b, _, _, s, e in ex]
    exons = spark.createDataFrame(ex + flip, "tx string, block int, chrom string, strand string, start int, end int")
    return genome, exons, left, right, me, 50 + 120 + intron.index("AG" + me) + 2, n


def S_rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_discovery_and_quantification(spark, world):
    genome, exons, left, right, me, at, n = world
    s = P.Settings(max_read_len=100, me_len=30, min_reads_psi=1)
    tags = P.tag_library(exons, genome, s).cache()
    assert tags.count() == 2
    assert {r.seq for r in tags.collect()} == {left[-100:] + right[:100]}
    reads = spark.createDataFrame([(f"r{i}", left[-40 + i :] + me + right[: 30 + i]) for i in range(5)] + [("plain", left[-30:] + right[:30])], "id string, seq string")
    hits = align.inserted_matches(reads, tags)
    found = P.discover(hits, tags, s)
    assert {r.me for r in found.collect()} == {f"chr_1_+_{at}_{at + len(me)}", f"chr2_-_{n - at - len(me)}_{n - at}"}
    table = P.microexon_table(found, spark.createDataFrame([], "me string, u2 double, cons double")).collect()
    assert len(table) == 1 or {t.sum_coverage for t in table} == {5}
    me_tags = tags.select(F.concat("id", F.lit("|me")).alias("tag"), F.col("id").alias("sj"), F.lit("m").alias("me"), "up", F.lit(len(me)).alias("me_len"))
    lib = me_tags.unionByName(tags.select(F.col("id").alias("tag"), F.col("id").alias("sj"), F.lit(None).cast("string").alias("me"), "up", F.lit(None).cast("int").alias("me_len")))
    seqs = tags.select(F.concat("id", F.lit("|me")).alias("id"), F.concat(F.substr("seq", F.lit(1), F.col("up").cast("int")), F.lit(me), F.substr("seq", (F.col("up") + 1).cast("int"))).alias("seq")).unionByName(tags.select("id", "seq")).where("id like 'chr_1%'")
    aligned = align.ungapped_matches(reads, seqs).select(F.lit("s1").alias("sample"), "tag", "start", F.length("seq").alias("matched"), "seq", F.lit(0).alias("flag"), "cigar")
    row = P.quantify(aligned, lib, s).first()
    assert (row.sample, row.inc, row.skip) == ("s1", 5, 1) and row.psi == pytest.approx(5 / 6)
    assert row.ci_lo < row.psi < row.ci_hi


def test_short_reads_align(spark):
    r = random.Random(4)
    tags = [("t%d" % i, "".join(r.choices("ACGT", k=60))) for i in range(6)]
    reads = []
    for n in (3, 7, 12, 20, 35, 36, 50):
        for i in range(4):
            t, s = r.choice(tags)
            at = r.randrange(len(s) - n + 1)
            seq = list(s[at : at + n])
            for _ in range(r.randint(0, 3)):
                seq[r.randrange(n)] = r.choice("ACGT")
            reads.append((f"r{n}_{i}", "".join(seq)))
    got = {(x.read, x.tag, x.start, x.mismatches) for x in align.ungapped_matches(spark.createDataFrame(reads, "id string, seq string"), spark.createDataFrame(tags, "id string, seq string")).collect()}
    want = {(i, t, p, d) for i, q in reads for t, s in tags for p in range(len(s) - len(q) + 1) if (d := sum(a != b for a, b in zip(q, s[p:]))) <= 2}
    assert got == want and len({x[0] for x in got}) > 20


def test_centric_groups_are_one_hop(spark):
    cand = lambda *m: [(x, 1.0 * len(x), 0.0) for x in m]
    rows = [("A", 2, 0.1, cand("m1", "m2")), ("B", 3, 0.2, cand("m2", "m3")), ("C", 5, 0.3, cand("m3", "m44"))]
    df = spark.createDataFrame(rows, "key string, coverage long, p_spurious double, candidates array<struct<me:string,u2:double,cons:double>>")
    got = {r.total_sjs: (r.me, r.sum_coverage, r.n_matches) for r in X.centric(df).collect()}
    assert got == {"A,B": ("m2", 5, 1), "B,C": ("m3", 8, 1)}  # the middle key's set A,B,C has no common candidate


def test_final_filter_without_lengths(spark):
    t = spark.createDataFrame([("m%d" % i, 3 + i % 2, float(i), 0.1, 1, 0.0) for i in range(10)], "me string, len int, u2 double, p_me double, n_matches int, cons double")
    n = spark.createDataFrame([("m%d" % i, i) for i in range(10)], "me string, n_samples int")
    out = P.final_filter(t, n, P.Settings(min_samples=5)).collect()
    assert {r.me for r in out} == {f"m{i}" for i in range(5, 10)} and {r.me_type for r in out} == {"IN"}


def test_intersect_runs(spark):
    df = spark.createDataFrame([("a", 0, 10), ("a", 5, 20), ("a", 8, 9), ("a", 30, 40), ("b", 1, 2)], "group string, start int, end int")
    assert sorted(tuple(r) for r in regions.intersect_runs(df).collect()) == [("a", 8, 9), ("a", 30, 40), ("b", 1, 2)]
    r = random.Random(2)
    rows = sorted({(g, a, a + r.choice((10, 500, 40_000))) for g in "ab" for a in (r.randrange(300_000) for _ in range(150))})
    want, run = [], None
    for g, a, b in [*rows, (None, 0, 0)]:
        if run and (g != run[0] or a >= run[2]):
            want.append(tuple(run))
            run = None
        run = [g, a, min(b, run[2])] if run else [g, a, b]
    assert sorted(tuple(x) for x in regions.intersect_runs(spark.createDataFrame(rows, "group string, start int, end int")).collect()) == sorted(want)


def test_isoforms(spark):
    ex = spark.createDataFrame([("t", "g", "c", "+", 0, 10, 0), ("t", "g", "c", "+", 100, 110, 1)], "tx string, gene string, chrom string, strand string, start int, end int, block int")
    mes = spark.createDataFrame([("m1", "c", "+", 10, 100, 40, 45), ("m2", "c", "+", 10, 100, 60, 66), ("m3", "c", "+", 10, 100, 0, 10)], "me string, chrom string, strand string, sj_start int, sj_end int, start int, end int")
    put = isoforms.inclusions(ex, mes)
    assert [r.me for r in put.collect()] == ["m1"]
    assert sorted((r.tx, r.start) for r in isoforms.isoforms(ex, put).collect()) == [("t_41", 0), ("t_41", 40), ("t_41", 100)]
    second = isoforms.secondary_isoforms(ex, put, mes)
    assert sorted((r.tx, r.start, r.end) for r in second.collect()) == [("t_61_66_m1", 0, 10), ("t_61_66_m1", 60, 66), ("t_61_66_m1", 100, 110)]
    new = isoforms.new_gtf_rows(ex, isoforms.isoforms(ex, put)).collect()
    assert [(r.start, r.end, r.attributes) for r in new if r.feature == "transcript"] == [(0, 110, 'gene_id "g"; transcript_id "t_41";')] and len(new) == 4


def brute_inclusions(exons, mes):
    """One candidate after the other, as a loop over transcripts puts them."""
    known = {(c, s, a, b) for _, _, c, s, a, b, _ in exons}
    new = sorted(m for m in mes if (m[1], m[2], m[5], m[6]) not in known)
    starts, ends = {}, {}
    for m in sorted(new, key=lambda m: (m[0], m[3], m[4])):
        starts.setdefault((m[1], m[2], m[3]), m)
        ends.setdefault((m[1], m[2], m[4]), m)
    taken, out = set(), []
    for tx in sorted({e[0] for e in exons}):
        own = sorted((e for e in exons if e[0] == tx), key=lambda e: (e[4], e[6]))
        lo, hi, past, had = min(e[4] for e in own), max(e[5] for e in own), None, set()
        for e, nxt in zip(own, own[1:]):
            gene, chrom, strand = e[1:4]
            here = (chrom, strand, e[5], nxt[4])
            for m, intron in ((starts.get((chrom, strand, e[5])), here), (ends.get((chrom, strand, e[4])), past)):
                if m and intron and (gene, intron) not in taken and m[0] not in had and lo < m[5] and m[6] < hi:
                    taken.add((gene, intron))
                    had.add(m[0])
                    out.append((tx, gene, m[0]))
            past = here
    return sorted(out)


def test_inclusions_match_one_by_one(spark):
    for seed in range(3):
        r = random.Random(seed)
        cuts = list(range(0, 400, 10))
        exons = []
        for t in range(25):
            edges = sorted(r.sample(cuts, 2 * r.randint(2, 6)))
            exons += [("t%02d" % t, "g%d" % (t % 3), "c", "+", a, b, i) for i, (a, b) in enumerate(zip(edges[::2], edges[1::2]))]
        mes = []
        for i in range(60):
            a, b = sorted(r.sample(cuts, 2))
            if b - a >= 20:
                at = r.randint(a + 3, b - 8)
                mes += [("m%02d" % i, "c", "+", a, b, at, at + 5)] + [("m%02d" % i, "c", "+", a - 10, b, at, at + 5)] * (i % 4 == 0)
        ex = spark.createDataFrame(exons, "tx string, gene string, chrom string, strand string, start int, end int, block int")
        m = spark.createDataFrame(mes, "me string, chrom string, strand string, sj_start int, sj_end int, start int, end int")
        got = sorted((x.tx, x.gene, x.me) for x in isoforms.inclusions(ex, m).collect())
        assert got == brute_inclusions(exons, mes) and len(got) > 20
        found = isoforms.in_transcripts(ex)
        assert got == sorted((x.tx, x.gene, x.me) for x in isoforms.inclusions(found.drop("block"), isoforms.unannotated(ex, m), new=True).collect())


def exchanges(df) -> int:
    """Exchanges of rows by key in a frame's plan."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_isoforms_exchange_rows_once(spark):
    """Rows are dealt by transcript once, microexons by each border once, and candidates by gene once."""
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ex = spark.createDataFrame([("t", "g", "c", "+", 0, 10, 0), ("t", "g", "c", "+", 100, 110, 1)], "tx string, gene string, chrom string, strand string, start int, end int, block int")
        m = spark.createDataFrame([("m1", "c", "+", 10, 100, 40, 45), ("m2", "c", "+", 10, 100, 60, 66)], "me string, chrom string, strand string, sj_start int, sj_end int, start int, end int")
        put = isoforms.inclusions(ex, m)
        assert exchanges(isoforms.isoforms(ex, put)) == 2
        assert exchanges(isoforms.secondaries(m)) == 3
        found = isoforms.in_transcripts(ex)
        assert exchanges(isoforms.candidates(found, m)) == 3 and exchanges(found) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_significant_nodes(spark):
    rows = [("g", n, "c", "+", t, 0.8, 0.2, 0.6 if k else d, p) for n, t, d, p in ((1, "CE", 0.6, 0.95), (2, "TE", 0.6, 0.95), (3, "CE", 0.0, 0.5)) for k, p in enumerate((p, p - 0.01, p + 0.01, p - 0.02))]
    df = spark.createDataFrame(rows, "gene string, node int, coord string, strand string, type string, psi_a double, psi_b double, delta double, probability double")
    got = {r.node: r for r in P.single_cell(df, cdf_t=0.5, min_delta=0.1, min_p=0.9, min_rep=3).collect()}
    assert [got[n]["diff"] for n in (1, 2, 3)] == [True, False, False]
    assert got[1].cdf < 1e-6 and got[1].number == 4
    assert not any(r["diff"] for r in P.single_cell(df, min_rep=4).collect())


def test_stranded(spark):
    assert spark.range(1).select(S.stranded(F.lit("AAC"), F.lit("-")).alias("x")).first().x == "GTT"


def test_entry_is_imported_without_a_session():
    """A driver imports the entry module before it makes its session."""
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert len(e.queries()) > 100 and e.oracle_sql()"], cwd=root, check=True)


def test_registered_queries_have_plans(spark):
    import __spark_entry__ as e

    known, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(known) and len(known) > 100
    assert e.entry(spark).limit(1).count() == 1


def test_exons_by_rows_a_task(spark, monkeypatch):
    """A task of the view of exons has a bounded number of rows, however many the table has."""
    from junctura.plans import registry

    monkeypatch.setattr(registry, "TASK_ROWS", 500)
    d = registry.v_exon(spark, "/root/testdata/sf0.001")
    sizes = [r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 1_000
    assert registry.parts_of(0, 8) == 1 and registry.parts_of(10**6, 8) == 2000 and registry.parts_of(400, 8) == 7


def test_inclusions_by_rows_a_task(spark, monkeypatch):
    """Candidates are dealt by their number, too: a round has as many parts as its rows need, whatever the session's number of partitions."""
    from junctura.plans import quantification as Q
    from junctura.plans import registry

    monkeypatch.setattr(registry, "TASK_ROWS", 500)
    sf = "/root/testdata/sf0.001"
    parts = registry.exon_parts(spark, sf)
    x = Q._annotation(spark, sf)
    mes = Q._mes_of(parts, x)
    assert parts >= 20 and mes.rdd.getNumPartitions() == parts
    put = isoforms.inclusions(x, mes, parts=parts)
    sizes = [r["count"] for r in put.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 500
    by = ["tx", "gene", "me", "start", "end"]
    assert sorted(put.select(*by).collect()) == sorted(isoforms.inclusions(x, mes).select(*by).collect())


@pytest.mark.parametrize("name", ["g1_skip_annotated", "a26_primary_secondary", "j22_intron_me", "a12_alt_cov", "j12_boundaries", "j13_adjacent_introns", "a29_intersect_runs", "j8_annot_anti", "p36_intron_ends"])
def test_exchanges_by_rows_a_task(spark, monkeypatch, name):
    """No exchange behind the view of exons goes into the session's number of partitions."""
    import __spark_entry__ as e
    from junctura.plans import registry

    monkeypatch.setattr(registry, "TASK_ROWS", 500)
    sf, key = "/root/testdata/sf0.001", "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = e.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, held)
    parts = [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\),", plan)]
    assert parts and min(parts) >= registry.exon_parts(spark, sf, 1) > 10, plan
