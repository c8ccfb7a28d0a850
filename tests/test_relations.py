"""Joins and list steps between the stages, on tables small enough to check by eye."""

import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from junctura.operators import annotation as A
from junctura.operators import coverage as Q
from junctura.operators import differential as D
from junctura.operators import discovery as X
from junctura.operators import isoforms as G
from junctura.operators import neighbours as N


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_annotated_mes(spark):
    genome = spark.createDataFrame([("c", "AAAGCCCGTAAAACGGGCTAA")], "chrom string, seq string")
    ex = spark.createDataFrame([("c", "+", 4, 7), ("c", "-", 4, 7), ("c", "-", 14, 17), ("c", "+", 0, 3), ("c", "+", 4, 20), ("d", "+", 4, 7), ("c", "+", 19, 22)], "chrom string, strand string, start int, end int")
    assert rows(A.annotated_mes(ex, genome, ex.limit(0), 5)) == [("c", "+", 4, 7), ("c", "-", 14, 17)]
    assert rows(A.annotated_mes(ex, genome, ex.where("strand = '-'"), 5)) == [("c", "+", 4, 7)]


def test_introns_per_read_and_sharing(spark):
    hits = spark.createDataFrame([("r", "a"), ("r", "a"), ("r", "b"), ("s", "b"), ("s", None)], "read string, intron string")
    assert rows(X.introns_per_read(hits)) == [("r", 2), ("s", 1)]
    assert rows(X.sharing(hits.union(hits), "intron", "read")) == [("a", "b", 1)]


def test_tags_and_flanks(spark):
    mes = spark.createDataFrame([("m", "x,y,z")], "me string, total_sjs string")
    tags = spark.createDataFrame([("x", "t1"), ("z", "t2"), ("w", "t3")], "sj string, tag string")
    assert rows(A.tags_of(mes, tags).select("me", "sj", "tag")) == [("m", "x", "t1"), ("m", "z", "t2")]
    gaps = spark.createDataFrame([("c", 5, 9), ("c", 5, 8)], "chrom string, start int, end int")
    up, down = spark.createDataFrame([("c", 5, "AA")], "chrom string, at int, up string"), spark.createDataFrame([("c", 9, "CC")], "chrom string, at int, down string")
    assert rows(A.flank_pairs(gaps, up, down).select("start", "end", "up", "down")) == [(5, 9, "AA", "CC")]


def test_counts_and_mates(spark):
    pairs = spark.createDataFrame([("m", "x", "y"), ("m", "y", "q")], "me string, sj string, me_tag string")
    counts = spark.createDataFrame([("x", 3), ("y", 4)], "tag string, reads long")
    assert rows(Q.with_counts(pairs, counts).select("sj", "sj_reads", "me_reads")) == [("x", 3, 4), ("y", 4, 0)]
    cov = spark.createDataFrame([("a", "m", 1, 2), ("b", "m", 3, 4), ("a", "n", 5, 6)], "sample string, me string, inc long, skip long")
    named = spark.createDataFrame([("a", "b")], "pair1 string, pair2 string")
    assert rows(Q.mates(cov, named).select("pair1", "pair2", "me", "inc", "mate_inc")) == [("a", "b", "m", 1, 3)]


def test_boundary_partners(spark):
    mes = spark.createDataFrame([("m", "c", "+", 10, 15), ("n", "c", "-", 30, 35)], "me string, chrom string, strand string, start int, end int")
    ex = [("t", "c", "+", 10, 40), ("u", "c", "+", 0, 15), ("v", "c", "-", 30, 60), ("w", "c", "+", 10, 12)]
    ex = [(*x, 0) for x in ex] + [(t, "c", s, 80, 99, 1) for t, _, s, _, _ in ex] + [("x", "c", "+", 2, 15, 0)]  # the last of x, and so no partner
    ex = spark.createDataFrame(ex, "tx string, chrom string, strand string, start int, end int, block int")
    both = Q.boundary_partners(mes, ex, 5)
    assert rows(both.select("me", "e_start", "e_end", "kind")) == [("m", 0, 15, "alt5"), ("m", 10, 40, "alt3"), ("n", 30, 60, "alt5")]
    gaps = spark.createDataFrame([("c", 2, 10, 7), ("c", 40, 50, 8), ("d", 2, 10, 9)], "chrom string, start int, end int, n long")
    assert rows(Q.adjacent_introns(both, gaps).select("me", "intron", "n")) == [("m", "L|10|2", 7), ("m", "R|40|50", 8)]


def test_mes_of_introns(spark):
    mes = spark.createDataFrame([("m2", "c", "+", 10, 100, 60, 66), ("m1", "c", "+", 10, 90, 40, 45)], "me string, chrom string, strand string, sj_start int, sj_end int, start int, end int")
    gaps = spark.createDataFrame([("t", "c", "+", 10, 100), ("u", "c", "-", 10, 100)], "tx string, chrom string, strand string, start int, end int")
    assert rows(G.mes_of_introns(gaps, mes).select("tx", "me", "by")) == [("t", "m1", "start"), ("t", "m2", "end")]


def test_comparison_lists(spark):
    cmp = spark.createDataFrame([("c1", "A", "x, y"), ("c1", "B", "z")], "comparison string, side string, clusters string")
    cells = spark.createDataFrame([("x", "f2"), ("y", "f1"), ("w", "f3")], "cluster string, file string")
    assert rows(D.named_clusters(cmp).select("side", "cluster")) == [("A", "x"), ("A", "y"), ("B", "z")]
    assert rows(D.side_files(cmp, cells)) == [("c1", "A", "f1,f2")]
    diff = spark.createDataFrame([("g", "1", True), ("g", "1", True), ("g", "2", False), ("h", "3", None)], "gene string, coord string, diff boolean")
    assert rows(D.targets(diff)) == [("g", "1")]


def test_neighbours_of_a_common_item(spark):
    """One item of very many keys, each with an item of its own: one list, not one for each key."""
    n = 60_000
    hot = spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit("hot").alias("i"))
    own = spark.range(n).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("own"), (F.col("id") / 2).cast("long").cast("string")).alias("i"))
    began = time.time()
    got = X.neighbour_sets(hot.unionByName(own), "k", "i").select(F.size("keys").alias("n")).collect()
    assert [r.n for r in got] == [n] and time.time() - began < 60
    r = random.Random(2)
    rows = sorted({(f"k{r.randint(0, 60)}", f"i{int(r.paretovariate(0.6)) % 40}") for _ in range(150)})
    keys = {k: {i for x, i in rows if x == k} for k, _ in rows}
    want = {tuple(sorted(o for o in keys if keys[o] & items)) for items in keys.values()}
    for wide in (1, 4, 1000):
        assert {tuple(x["keys"]) for x in X.neighbour_sets(spark.createDataFrame(rows, "k string, i string"), "k", "i", wide).collect()} == want


def test_neighbour_lists_move_once(spark):
    """Only lists of keys whose marks are those of other sets are compared, and keys that fit are moved as ints."""
    r = random.Random(5)
    for far in (0, 1 << 31, -(1 << 31), -(1 << 31) - 1):
        rows = {(r.randrange(300) + far, r.randrange(200)) for _ in range(500)} | {(1000 + k + far, 900) for k in range(5)}
        d = X.neighbour_sets(spark.createDataFrame(sorted(rows), "k long, i long"), "k", "i")
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate [keys#") == 1 and "NOT alone" in plan and d.schema["keys"].dataType.simpleString() == "array<bigint>"
        of, items = {}, {}
        for k, i in rows:
            of.setdefault(k, set()).add(i)
            items.setdefault(i, set()).add(k)
        want = sorted({tuple(sorted(set().union(*(items[i] for i in x)))) for x in of.values()})
        assert sorted(tuple(x["keys"]) for x in d.collect()) == want


def test_neighbour_lists_move_once_to_a_part(spark, monkeypatch):
    """Lists are not joined to each of their keys: one goes once to each part of the keys, so that keys made together cost no more than their lists."""
    monkeypatch.setattr(N, "PART_PAIRS", 100)
    r = random.Random(7)
    ints = sorted({(70 * c + r.randrange(50), 9 * c + r.randrange(9)) for c in range(12) for _ in range(100)})
    words = sorted({(f"é{r.randrange(90)}ü", f"i{r.randrange(60)}") for _ in range(300)})
    for rows, kinds in ((ints, "k int, i long"), (words, "k string, i string"), ([], "k long, i long")):
        d = X.neighbour_sets(spark.createDataFrame(rows + [(None, 1 if rows is not words else "i1")], kinds), "k", "i")
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        assert ("Join" in plan) == (rows is words) and d.schema["keys"].dataType.elementType.simpleString() == kinds.split()[1].strip(",").replace("long", "bigint")
        of, items = {}, {}
        for k, i in rows:
            of.setdefault(k, set()).add(i)
            items.setdefault(i, set()).add(k)
        want = sorted({tuple(sorted(set().union(*(items[i] for i in x)))) for x in of.values()})
        assert sorted(tuple(x["keys"]) for x in d.collect()) == want
    lists = spark.createDataFrame(ints, "k int, i long").groupBy("i").agg(F.array_sort(F.collect_set("k")).alias("ks")).withColumn("own", F.col("ks"))
    n, parts = lists.count(), N.parts_of_pairs(len(ints), 0, 1)
    moved = sum(pa.ipc.open_stream(x["packed"]).read_all().num_rows for x in N.packed_lists(lists, parts, len(ints) / n).collect())
    assert parts > 6 and n <= moved <= 3 * n < len(ints)


def test_neighbours_of_common_items_in_parts(spark, monkeypatch):
    """Keys that are integers, common items and several parts: one key asks for each set of items."""
    monkeypatch.setattr(N, "PART_PAIRS", 20)
    r = random.Random(3)
    rows = sorted({(r.choice((-1, 1)) * r.randint(0, 60) << 41, int(r.paretovariate(0.6)) % 40) for _ in range(150)})
    keys = {k: {i for x, i in rows if x == k} for k, _ in rows}
    want = sorted({tuple(sorted(o for o in keys if keys[o] & items)) for items in keys.values()})
    for wide in (1, 4, 1000):
        assert sorted(tuple(x["keys"]) for x in X.neighbour_sets(spark.createDataFrame(rows, "k long, i long"), "k", "i", wide).collect()) == want
