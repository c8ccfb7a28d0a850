"""Queries on the joins, filters and list steps that tie the stages together."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions import keys as K
from ..operators import annotation as A
from ..operators import coverage as Q
from ..operators import differential as D
from ..operators import discovery as X
from ..operators import isoforms as G
from ..sources import text as IO
from ..sources.shared import shared_folder
from .quantification import _BOUND, _CMP, _MES, _comparisons, _intron_counts, _mes, _short
from .registry import exon_parts, query, table, v_align, v_cell, v_cov, v_dna, v_exon, v_node
from .sequences import _CUT


def long(c: str):
    return F.col(c).cast("long").alias(c)


# reads and tags -------------------------------------------------------------------------------------------------------------------------


@query("SELECT read, count(DISTINCT tag) AS introns FROM v_align GROUP BY read", "v_align")
def a2_introns_per_read(spark, sf):
    return X.introns_per_read(v_align(spark, sf), "read", "tag")


@query("SELECT read, line, tag, supp, cigar FROM v_align WHERE contains(cigar, 'I')", "v_align")
def f2_has_insertion(spark, sf):
    return v_align(spark, sf).where(F.contains("cigar", F.lit("I"))).select("read", "line", "tag", "supp", "cigar")


@query(
    """WITH t AS (SELECT CAST(o_orderkey AS BIGINT) AS read, CAST(o_custkey % 60 AS BIGINT) AS t_score FROM orders),
g AS (SELECT read, score AS g_score, tag FROM v_align QUALIFY row_number() OVER (PARTITION BY read ORDER BY score DESC, line, tag, supp) = 1)
SELECT t.read, t_score, g_score, tag FROM t LEFT JOIN g ON g.read = t.read""",
    "v_align",
)
def j3_best_genome(spark, sf):
    """Reads (orders) with their best alignment to the genome (line items), or none."""
    d = v_align(spark, sf)
    row = (F.col("line").cast("long") * 1_000_000_000 + F.col("tag")) * 100_000 + F.col("supp")
    best = X.best_alignment(d.select("read", "score", row.alias("row"), "tag"))
    reads = table(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("read"), (F.col("o_custkey") % 60).cast("long").alias("t_score"))
    return reads.join(best.select("read", F.col("score").alias("g_score"), "tag"), "read", "left").select("read", "t_score", "g_score", "tag")


@query("WITH d AS (SELECT DISTINCT read, tag FROM v_align) SELECT a.tag AS k, b.tag AS other, count(*) AS shared FROM d a JOIN d b ON a.read = b.read AND a.tag < b.tag GROUP BY ALL", "v_align")
def j6_sharing_keys(spark, sf):
    return X.sharing(v_align(spark, sf), "tag", "read")


@query(f"SELECT read, line, tag, supp, list_contains(list_transform(b, lambda x: x[1] || '-' || x[2]), CAST(\"start\" AS VARCHAR) || '-' || (\"start\" + score)) AS same_me FROM ({_CUT})", "v_align")
def j24_same_me(spark, sf):
    """Is a block of the alignment the candidate?  Whole coordinates are compared."""
    span = lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string"))
    blocks = F.transform(C.exon_blocks(F.col("start"), C.parse(F.col("cigar"))), lambda x: span(x["start"], x["end"]))
    return v_align(spark, sf).select("read", "line", "tag", "supp", X.same_exon(blocks, F.array(span(F.col("start"), F.col("start") + F.col("score")))).alias("same_me"))


@query(
    """SELECT doc_id, CAST(i + 2 AS BIGINT) AS at FROM (SELECT doc_id, seq, unnest(range(0, greatest(length(seq) - 6, 0))) AS i FROM v_dna WHERE length(seq) >= 13)
WHERE substr(seq, CAST(i + 1 AS INTEGER), 7) = 'AG' || substr(seq, 11, 3) || 'GT'""",
    "v_dna",
)
def j25_substring_search(spark, sf):
    """Places of a short exon between AG and GT in its own sequence."""
    d = v_dna(spark, sf).where(F.length("seq") >= 13).select("doc_id", F.col("seq").alias("intron_seq"), F.substring("seq", 11, 3).alias("me_seq"))
    return X.candidates(d).select("doc_id", long("at"))


# annotation -----------------------------------------------------------------------------------------------------------------------------

_INTRON_ID = "chrom || ':' || \"start\" || strand || \"end\""


def _of_orders(spark, sf, rows, *statuses: str):
    """Rows of the transcripts whose order has one of the statuses: the second table of a join."""
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus").isin(*statuses)).select(F.col("o_orderkey").alias("tx"))
    return rows.join(orders, "tx", "left_semi")


def _genome(spark, sf):
    return v_dna(spark, sf).select(F.concat(F.lit("chr"), F.col("doc_id").cast("string")).alias("chrom"), "seq")


@query(
    """WITH m AS (SELECT DISTINCT chrom, strand, "start" AS s, "end" AS e FROM v_exon WHERE "end" - "start" <= 12 AND "start" >= 2),
d AS (SELECT DISTINCT chrom, strand, "start" AS s, "end" AS e FROM v_exon JOIN orders ON o_orderkey = tx WHERE o_orderstatus = 'F')
SELECT m.chrom, m.strand, CAST(s AS BIGINT) AS "start", CAST(e AS BIGINT) AS "end" FROM (SELECT * FROM m EXCEPT SELECT * FROM d) m JOIN (SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom, seq FROM v_dna) g ON g.chrom = m.chrom
WHERE substr(seq, s - 1, 2) || substr(seq, e + 1, 2) = CASE WHEN strand = '-' THEN 'ACCT' ELSE 'AGGT' END""",
    "v_exon",
    "v_dna",
)
def f12_annotated_me(spark, sf):
    """Annotated microexons that the found ones do not hold yet."""
    e = v_exon(spark, sf)
    # what was found are the exons of finished orders
    return A.annotated_mes(e, _genome(spark, sf), _of_orders(spark, sf, e, "F"), 12).select("chrom", "strand", long("start"), long("end"))


@query("SELECT tx, blocks, CAST(length(seq) AS BIGINT) AS n FROM (SELECT CAST(tx AS BIGINT) AS tx, count(*) AS blocks FROM v_exon GROUP BY tx) JOIN v_dna ON doc_id = tx", "v_exon", "v_dna")
def j1_tx_join(spark, sf):
    """Transcripts that the transcriptome holds; others are dropped."""
    tx = A.exons_bed12(v_exon(spark, sf)).select(F.col("name").cast("long").alias("tx"), F.col("block_count").cast("long").alias("blocks"))
    return tx.join(v_dna(spark, sf).select(F.col("doc_id").alias("tx"), F.length("seq").cast("long").alias("n")), "tx")


@query(
    f"""WITH t AS (SELECT {_INTRON_ID} AS sj, CAST(min(tx) AS BIGINT) AS tag FROM v_intron JOIN orders ON o_orderkey = tx WHERE o_orderstatus <> 'P' GROUP BY 1),
m AS (SELECT DISTINCT chrom || '_' || ("start" % 50) AS me, {_INTRON_ID} AS sj FROM v_intron) SELECT me, m.sj, tag FROM m JOIN t ON t.sj = m.sj""",
    "v_intron",
)
def j7_tag_join(spark, sf):
    g = A.introns(v_exon(spark, sf)).withColumn("sj", F.concat("chrom", F.lit(":"), "start", "strand", "end"))
    mes = g.groupBy(F.concat_ws("_", "chrom", (F.col("start") % 50).cast("string")).alias("me")).agg(F.array_join(F.collect_set("sj"), ",").alias("total_sjs"))
    tags = _of_orders(spark, sf, g, "F", "O").groupBy("sj").agg(F.min("tx").cast("long").alias("tag"))
    return A.tags_of(mes, tags).select("me", "sj", "tag")


@query(
    """WITH u AS (SELECT chrom, "end" AS at, CAST(max(len) AS BIGINT) AS up FROM v_exon JOIN orders ON o_orderkey = tx WHERE o_orderstatus = 'F' GROUP BY ALL), d AS (SELECT chrom, "start" AS at, CAST(max(len) AS BIGINT) AS down FROM v_exon JOIN orders ON o_orderkey = tx WHERE o_orderstatus <> 'F' GROUP BY ALL)
SELECT CAST(i.tx AS BIGINT) AS tx, i.block, up, down FROM v_intron i JOIN u ON u.chrom = i.chrom AND u.at = i."start" JOIN d ON d.chrom = i.chrom AND d.at = i."end\"""",
    "v_intron",
)
def j10_flank_join(spark, sf):
    """Introns with what is known of both their flanks; lengths stand in for sequences."""
    e = v_exon(spark, sf)
    ups = _of_orders(spark, sf, e, "F").groupBy("chrom", F.col("end").alias("at")).agg(F.max("len").alias("up"))
    downs = _of_orders(spark, sf, e, "O", "P").groupBy("chrom", F.col("start").alias("at")).agg(F.max("len").alias("down"))
    return A.flank_pairs(A.introns(e), ups, downs).select(long("tx"), "block", "up", "down")


@query('SELECT CAST(tx AS BIGINT) AS tx, block, CAST("end" AS BIGINT) AS "end", CAST(nxt AS BIGINT) AS next FROM (SELECT *, lead("start") OVER (PARTITION BY tx ORDER BY "start", block) AS nxt FROM v_exon) WHERE nxt IS NOT NULL', "v_exon")
def w1_next_block(spark, sf):
    return A.introns(v_exon(spark, sf)).select(long("tx"), "block", F.col("start").cast("long").alias("end"), F.col("end").cast("long").alias("next"))


# coverage -------------------------------------------------------------------------------------------------------------------------------


@query(
    """WITH c AS (SELECT tag, count(*) AS reads FROM v_align WHERE score > 25 GROUP BY tag), m AS (SELECT DISTINCT supp AS me, tag AS sj FROM v_align)
SELECT me, m.sj, coalesce(a.reads, 0) AS sj_reads, coalesce(b.reads, 0) AS me_reads FROM m LEFT JOIN c a ON a.tag = m.sj LEFT JOIN c b ON b.tag = m.sj + 1""",
    "v_align",
)
def j11_counts(spark, sf):
    d = v_align(spark, sf)
    counts = d.where("score > 25").groupBy("tag").agg(F.count("*").alias("reads"))
    return Q.with_counts(d.select(F.col("supp").alias("me"), F.col("tag").alias("sj"), (F.col("tag") + 1).alias("me_tag")).distinct(), counts).select("me", "sj", "sj_reads", "me_reads")


def _partners(spark, sf):
    e = v_exon(spark, sf)
    parts = exon_parts(spark, sf)
    return e, Q.boundary_partners(_short(e, parts), e, 12, parts), parts


@query(f"WITH {_BOUND} SELECT me, kind, chrom, CAST(xs AS BIGINT) AS e_start, CAST(xe AS BIGINT) AS e_end FROM b", "v_intron")
def j12_boundaries(spark, sf):
    _, both, _ = _partners(spark, sf)
    return both.select("me", "kind", "chrom", long("e_start"), long("e_end"))


@query(f"WITH {_BOUND} SELECT me, kind, CAST(xs AS BIGINT) AS e_start, CAST(xe AS BIGINT) AS e_end, i AS intron, n FROM h", "v_intron")
def j13_adjacent_introns(spark, sf):
    e, both, parts = _partners(spark, sf)
    return Q.adjacent_introns(both, _intron_counts(e, parts), parts)


@query("SELECT sample, me, inc FROM v_cov WHERE me IN (SELECT me FROM v_cov GROUP BY me HAVING count(*) FILTER (WHERE inc >= 2) >= 3)", "v_cov")
def j14_in_list(spark, sf):
    cov = v_cov(spark, sf)
    return cov.join(Q.samples_passing(cov, 2).where("n_samples >= 3"), "me", "left_semi").select("sample", "me", "inc")


@query("SELECT a.sample AS pair1, b.sample AS pair2, me, a.inc, b.inc AS mate_inc FROM v_cov a JOIN v_cov b USING (me) WHERE a.sample % 2 = 0 AND b.sample = a.sample + 1", "v_cov")
def j17_pair_join(spark, sf):
    cov = v_cov(spark, sf)
    pairs = cov.where("sample % 2 = 1").select((F.col("sample") - 1).alias("pair1"), F.col("sample").alias("pair2")).distinct()
    return Q.mates(cov, pairs).select("pair1", "pair2", "me", "inc", "mate_inc")


# isoforms -------------------------------------------------------------------------------------------------------------------------------


@query(
    """SELECT CAST(p_partkey AS VARCHAR) || '.' || p_size AS tx, CASE WHEN s IS NOT NULL THEN 'g' || CAST(p_partkey AS VARCHAR) END AS gene, coalesce(p_partkey % 3 = 1 AND s IS NOT NULL, FALSE) AS exact
FROM part LEFT JOIN (SELECT DISTINCT l_partkey AS s FROM lineitem WHERE l_returnflag = 'R') ON s = p_partkey""",
)
def j21_tx_gene(spark, sf):
    """Genes by id, else by the id without version, else none."""
    p = table(spark, sf, "part").withColumn("key", F.col("p_partkey").cast("string")).withColumn("tx", F.concat_ws(".", "key", "p_size"))
    known = F.when(F.col("p_partkey") % 3 == 1, F.col("tx")).otherwise(F.concat("key", F.lit(".9999")))
    listed = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")).distinct()
    genes = p.join(listed, "p_partkey", "left_semi").select(known.alias("tx"), F.concat(F.lit("g"), "key").alias("gene"))
    exact = genes.select("tx", F.lit(True).alias("hit"))
    return G.with_gene(p.select("tx"), genes).join(exact, "tx", "left").select("tx", "gene", F.coalesce("hit", F.lit(False)).alias("exact"))


@query(
    f"""WITH {_MES}, a AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY chrom, strand, sj_start ORDER BY me, sj_start, sj_end) = 1),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY chrom, strand, sj_end ORDER BY me, sj_start, sj_end) = 1)
SELECT CAST(tx AS BIGINT) AS tx, block, me, 'start' AS by FROM v_intron i JOIN a ON a.chrom = i.chrom AND a.strand = i.strand AND a.sj_start = i."start"
UNION ALL SELECT tx, block, me, 'end' FROM v_intron i JOIN b ON b.chrom = i.chrom AND b.strand = i.strand AND b.sj_end = i."end\"""",
    "v_intron",
)
def j22_intron_me(spark, sf):
    return G.mes_of_introns(A.introns(v_exon(spark, sf)), _mes(spark, sf), exon_parts(spark, sf)).select(long("tx"), "block", "me", "by")


@query(
    """WITH x AS (SELECT CAST(tx AS VARCHAR) AS gene, chrom, max("end") AS e FROM v_exon GROUP BY ALL)
SELECT gene, x.chrom, CAST(e AS BIGINT) AS "end" FROM x JOIN (SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom, length(seq) AS size FROM v_dna) s ON s.chrom = x.chrom AND size > e""",
    "v_exon",
    "v_dna",
)
def j27_theta(spark, sf):
    sizes = _genome(spark, sf).select("chrom", F.length("seq").alias("size"))
    return G.in_chromosome(G.gene_extents(v_exon(spark, sf).withColumn("gene", F.col("tx").cast("string"))), sizes).select("gene", "chrom", long("end"))


# comparisons ----------------------------------------------------------------------------------------------------------------------------

_SPEC = {"c1": {"A": "1,2,3", "B": "4, 5"}, "c2": {"A": "1,7", "B": "8,9,10"}}
_SIDES = "s AS (SELECT * FROM (VALUES ('c1', 'A', 1), ('c1', 'A', 2), ('c1', 'A', 3), ('c1', 'B', 4), ('c1', 'B', 5), ('c2', 'A', 1), ('c2', 'A', 7), ('c2', 'B', 8), ('c2', 'B', 9), ('c2', 'B', 10)) t(comparison, side, sample))"


@query(f"WITH {_SIDES} SELECT comparison, side, v.sample, me, inc, skip FROM s JOIN v_cov v ON v.sample = s.sample", "v_cov")
def j28_sides(spark, sf):
    sides = IO.comparisons(spark, _SPEC).withColumn("sample", F.col("sample").cast("long"))
    return v_cov(spark, sf).join(sides, "sample").select("comparison", "side", "sample", "me", "inc", "skip")


@query("SELECT 'cmp' || CAST(sample % 3 AS VARCHAR) AS comparison, CASE WHEN sample % 2 = 0 THEN 'A' ELSE 'B' END AS side, sample, me, inc, skip FROM v_cov", "v_cov")
def s18_comparison_file(spark, sf):
    """All samples listed in a comparison file, which is written from the table and read as YAML."""
    path = shared_folder(spark, "comparisons")
    cov = v_cov(spark, sf)
    of = {"comparison": F.concat(F.lit("cmp"), (F.col("sample") % 3).cast("string")), "side": F.when(F.col("sample") % 2 == 0, "A").otherwise("B")}
    listed = cov.select("sample", *(c.alias(n) for n, c in of.items())).groupBy("comparison", "side").agg(F.array_join(F.array_sort(F.collect_set("sample")).cast("array<string>"), ", ").alias("samples"))
    sides = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("side", "samples"))), lambda x: F.concat(F.lit("\n  "), x["side"], F.lit(": "), x["samples"])), "")
    listed.groupBy("comparison").agg(sides.alias("s")).select(F.concat("comparison", F.lit(":  # one of three"), "s")).write.text(path)
    found = IO.comparison_file(spark, path).withColumn("sample", F.col("sample").cast("long"))
    return cov.join(found, "sample").select("comparison", "side", "sample", "me", "inc", "skip")


@query(
    """SELECT DISTINCT 'n' || c_nationkey AS comparison, side, c_mktsegment AS cluster, n_pools, repeats FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS side,
CAST(1 + max(c_custkey) OVER (PARTITION BY c_nationkey, c_custkey % 2) % 7 AS INTEGER) AS n_pools, CAST(1 + min(c_custkey) OVER (PARTITION BY c_nationkey, c_custkey % 2) % 3 AS INTEGER) AS repeats FROM customer)"""
)
def d2_clusters(spark, sf):
    """Comparisons of the customers' segments by nation, as a table of comma lists that is written and parsed."""
    path = shared_folder(spark, "clusters")
    c = table(spark, sf, "customer").withColumn("side", F.when(F.col("c_custkey") % 2 == 0, "A").otherwise("B"))
    listed = F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ", ").alias("clusters")
    rows = c.groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("comparison"), "side").agg(listed, (1 + F.max("c_custkey") % 7).alias("n_pools"), (1 + F.min("c_custkey") % 3).alias("repeats"))
    rows.write.option("sep", "\t").option("header", True).csv(path)
    found = IO.table(spark, path).withColumns({n: F.col(n).cast("int") for n in ("n_pools", "repeats")})
    return D.named_clusters(found).select("comparison", "side", "cluster", "n_pools", "repeats")


@query(f"WITH {_CMP} SELECT comparison, side, string_agg(CAST(file AS VARCHAR), ',' ORDER BY file) AS files FROM c JOIN v_cell USING (cluster) GROUP BY ALL", "v_cell")
def d7_file_lists(spark, sf):
    return D.side_files(_comparisons(spark), v_cell(spark, sf))


@query("SELECT DISTINCT gene, chrom || ':' || (\"start\" + 1) || '-' || \"end\" AS coord FROM v_node WHERE psi >= 0.5 AND type NOT IN ('TE', 'TS')", "v_node")
def d8_targets(spark, sf):
    n = v_node(spark, sf)
    return D.targets(n.select("gene", K.coordinate(F.col("chrom"), F.col("start"), F.col("end")).alias("coord"), ((F.col("psi") >= 0.5) & ~F.col("type").isin("TE", "TS")).alias("diff")))
