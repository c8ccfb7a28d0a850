"""Queries on sequences, alignments and annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions import keys as K
from ..functions import sequence as S
from ..operators import annotation as A
from ..operators import coverage as Q
from ..operators import discovery as D
from ..operators import genome as G
from ..operators import regions as R
from ..sources import text as IO
from ..sources.shared import shared_folder
from .registry import query, table, v_align, v_dna, v_exon

_COMP = "reverse(translate(seq, 'ACGT', 'TGCA'))"


def long(c: str, *more):
    return F.col(c).cast("long").alias(c)


@query("SELECT doc_id, seq[6:45] AS seq, CAST(length(seq) AS BIGINT) AS n FROM v_dna", "v_dna")
def p7_slice(spark, sf):
    return v_dna(spark, sf).select("doc_id", S.slice_seq(F.col("seq"), F.lit(5), F.lit(45)).alias("seq"), F.length("seq").cast("long").alias("n"))


@query(f"SELECT doc_id, {_COMP} AS rc FROM v_dna", "v_dna")
def p8_revcomp(spark, sf):
    return v_dna(spark, sf).select("doc_id", S.revcomp(F.col("seq")).alias("rc"))


@query("SELECT doc_id, substr(seq, 1, 2) || right(seq, 2) AS dn, (substr(seq, 1, 2) || right(seq, 2)) IN ('GTAG', 'GCAG', 'ATAC') AS canonical FROM v_dna WHERE length(seq) >= 4", "v_dna")
def p9_splice_dinuc(spark, sf):
    dn = S.splice_dinucleotides(F.col("seq"))
    return v_dna(spark, sf).where(F.length("seq") >= 4).select("doc_id", dn.alias("dn"), S.canonical(dn).alias("canonical"))


@query("SELECT doc_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(i) AS BIGINT) AS places FROM (SELECT doc_id, seq, unnest(range(0, greatest(length(seq) - 3, 0))) AS i FROM v_dna) WHERE substr(seq, CAST(i + 1 AS INTEGER), 4) = 'ACAC' GROUP BY doc_id", "v_dna")
def p20_overlap_matches(spark, sf):
    places = v_dna(spark, sf).select("doc_id", F.explode(S.overlapping(F.col("seq"), F.lit("ACAC"))).alias("i"))
    return places.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("i").alias("places"))


@query("SELECT doc_id, CAST((length(seq) - length(replace(seq, 'ACAC', ''))) / 4 AS BIGINT) AS n FROM v_dna", "v_dna")
def p21_nonoverlap_count(spark, sf):
    return v_dna(spark, sf).select("doc_id", S.count_apart(F.col("seq"), F.lit("ACAC")).alias("n"))


@query("SELECT doc_id, substr(seq, 1, 20) || 'AGGT' || substr(seq, 21) AS tag FROM v_dna", "v_dna")
def p26_tag_insert(spark, sf):
    return v_dna(spark, sf).select("doc_id", A.insert_in_tag(F.col("seq"), F.lit(20), F.lit("AGGT")).alias("tag"))


_INTRONS = 'SELECT tx, block, CAST("end" - "start" AS BIGINT) AS n, CAST(3 + tx % 8 AS BIGINT) AS len FROM v_intron'


def _introns(spark, sf) -> DataFrame:
    return A.introns(v_exon(spark, sf)).select("tx", "block", (F.col("end") - F.col("start")).cast("long").alias("n"), (3 + F.col("tx") % 8).alias("len"))


@query(f"SELECT tx, block, round(1 - pow(1 - pow(4.0, -(len + 4)), n - (len + 4)), 9) AS p FROM ({_INTRONS})", "v_intron")
def p24_spurious_prob(spark, sf):
    return _introns(spark, sf).select("tx", "block", F.round(S.spurious_denovo(F.col("len"), F.col("n")), 9).alias("p"))


@query(f"SELECT tx, block, round(1 - pow(1 - 1 / (pow(4.0, len) + 4), n - (len + 4)), 9) AS p FROM ({_INTRONS})", "v_intron")
def p25_spurious_prob_annot(spark, sf):
    return _introns(spark, sf).select("tx", "block", F.round(S.spurious_annotated(F.col("len"), F.col("n")), 9).alias("p"))


_OPS = r"regexp_extract_all(cigar, '(\d+)(\D)', 2)"
_LENS = r"list_transform(regexp_extract_all(cigar, '(\d+)(\D)', 1), lambda x: CAST(x AS INTEGER))"


def _sum_sql(kinds: str) -> str:
    return f"list_sum(list_transform(list_zip({_OPS}, {_LENS}), lambda x: CASE WHEN contains('{kinds}', x[1]) THEN x[2] ELSE 0 END))"


def _count_sql(kinds: str) -> str:
    return f"len(list_filter({_OPS}, lambda x: contains('{kinds}', x)))"


@query(f"SELECT cigar, array_to_string({_OPS}, '') AS ops, CAST(list_sum({_LENS}) AS BIGINT) AS total, count(*) AS n FROM v_align GROUP BY cigar", "v_align")
def p11_cigar_parse(spark, sf):
    d = v_align(spark, sf).groupBy("cigar").agg(F.count("*").alias("n")).withColumn("o", C.parse(F.col("cigar")))
    return d.select("cigar", F.array_join(F.transform("o", lambda x: x["op"]), "").alias("ops"), F.aggregate("o", F.lit(0), lambda a, x: a + x["len"]).cast("long").alias("total"), "n")


@query(
    r"""SELECT read, line, tag, supp, CASE supp % 5 WHEN 0 THEN '0-' || q || ',' || (q + l) || '-' || (q + l + p) WHEN 1 THEN '0-' || (q + p) WHEN 2 THEN '0-' || (q + l + p + l + q) ELSE '0-' || q END AS blocks
FROM (SELECT *, score AS q, line AS l, tag % 50 + 10 AS p FROM v_align)""",
    "v_align",
)
def p12_query_blocks(spark, sf):
    d = v_align(spark, sf).withColumn("b", C.query_blocks(C.parse(F.col("cigar"))))
    text = F.array_join(F.transform("b", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return d.select("read", "line", "tag", "supp", text.alias("blocks"))


_CUT = r"""SELECT *, CASE supp % 5 WHEN 0 THEN [["start", "start" + q + p]] WHEN 1 THEN [["start", "start" + q], ["start" + q + p, "start" + q + p + p]]
  WHEN 2 THEN [["start", "start" + q + line + p], ["start" + q + line + p + p, "start" + q + line + p + p + line], ["start" + q + line + p + p + line + p, "start" + q + line + p + p + line + p + q]] ELSE [["start", "start" + q]] END AS b
  FROM (SELECT *, score AS q, tag % 50 + 10 AS p FROM v_align)"""


@query(f"SELECT read, line, tag, supp, array_to_string(list_transform(b, lambda x: x[1] || '-' || x[2]), ',') AS blocks FROM ({_CUT})", "v_align")
def p13_exon_blocks(spark, sf):
    d = v_align(spark, sf).withColumn("b", C.exon_blocks(F.col("start"), C.parse(F.col("cigar"))))
    return d.select("read", "line", "tag", "supp", F.array_join(F.transform("b", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("blocks"))


@query(r"SELECT cigar, array_to_string(list_reverse(regexp_extract_all(cigar, '\d+\D')), '') AS reversed, count(*) AS n FROM v_align GROUP BY cigar", "v_align")
def p14_cigar_reverse(spark, sf):
    return v_align(spark, sf).groupBy("cigar").agg(F.count("*").alias("n")).select("cigar", C.text(C.reverse(C.parse(F.col("cigar")))).alias("reversed"), "n")


@query(f"SELECT cigar, CAST({_sum_sql('MI')} - {_count_sql('D')} AS BIGINT) AS tag_score, CAST({_sum_sql('M')} - {_sum_sql('I')} - {_count_sql('D')} AS BIGINT) AS genome_score, count(*) AS n FROM v_align GROUP BY cigar", "v_align")
def p15_align_score(spark, sf):
    d = v_align(spark, sf).groupBy("cigar").agg(F.count("*").alias("n")).withColumn("o", C.parse(F.col("cigar")))
    return d.select("cigar", C.tag_score(F.col("o")).cast("long").alias("tag_score"), C.genome_score(F.col("o")).cast("long").alias("genome_score"), "n")


@query("SELECT flag, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, CASE WHEN ((flag & 16) <> 0) <> ((flag & 128) <> 0) THEN '-' ELSE '+' END AS pair_strand, count(*) AS n FROM v_align GROUP BY flag", "v_align")
def p16_flag_strand(spark, sf):
    return v_align(spark, sf).groupBy("flag").agg(F.count("*").alias("n")).select("flag", C.strand(F.col("flag")).alias("strand"), C.strand(F.col("flag"), True).alias("pair_strand"), "n")


@query(
    """SELECT read, tag_name AS tag, CAST(count(*) AS BIGINT) AS n FROM (SELECT read, 't' || tag AS tag_name FROM v_align
UNION ALL SELECT read, 't' || (tag + 1) FROM v_align WHERE score % 2 = 0) GROUP BY ALL""",
    "v_align",
)
def p17_alt_hits(spark, sf):
    d = v_align(spark, sf)
    name = lambda c: F.concat(F.lit("t"), c.cast("string"))
    others = F.concat(name(F.col("tag") + 1), F.lit(",+5,9M,0;"), name(F.col("tag") + 2), F.lit(",-5,9M,0;"))
    sam = d.select("read", name(F.col("tag")).alias("tag"), "start", "cigar", "score", (F.col("score") + F.col("score") % 2).alias("second"), others.alias("others"))
    return D.alternative_hits(sam).groupBy("read", "tag").agg(F.count("*").alias("n"))


def _prefix_sql(a: str, b: str) -> str:
    return f"CAST(coalesce(list_min(list_filter(range(1, least(length({a}), length({b})) + 1), lambda i: substr({a}, CAST(i AS INTEGER), 1) <> substr({b}, CAST(i AS INTEGER), 1))) - 1, least(length({a}), length({b}))) AS BIGINT)"


# annotation -----------------------------------------------------------------------------------------------------------------------------


@query(
    """SELECT CAST(tx AS VARCHAR) AS name, chrom, strand, CAST(min("start") AS BIGINT) AS "start", CAST(max("end") AS BIGINT) AS "end", count(*) AS block_count, string_agg(CAST("end" - "start" AS VARCHAR), ',' ORDER BY "start", "end") AS block_sizes,
string_agg(CAST("start" - first AS VARCHAR), ',' ORDER BY "start", "end") AS block_starts FROM (SELECT *, min("start") OVER (PARTITION BY tx) AS first FROM v_exon) GROUP BY tx, chrom, strand""",
    "v_exon",
)
def p1_bed12(spark, sf):
    return A.exons_bed12(v_exon(spark, sf)).select(F.col("name").cast("string").alias("name"), "chrom", "strand", long("start"), long("end"), long("block_count"), "block_sizes", "block_starts")


@query('SELECT tx, chrom, strand, CAST("start" AS BIGINT) AS "start", CAST("end" AS BIGINT) AS "end" FROM v_exon', "v_exon")
def p2_exons(spark, sf):
    """Exons back from BED12 rows."""
    bed = A.exons_bed12(v_exon(spark, sf)).withColumns({c: IO.int_list(F.col(c)) for c in ("block_sizes", "block_starts")})
    return A.bed12_exons(bed).select("tx", "chrom", "strand", long("start"), long("end"))


@query('SELECT tx, CAST(block AS BIGINT) AS block, chrom, strand, CAST("start" AS BIGINT) AS "start", CAST("end" AS BIGINT) AS "end" FROM v_intron', "v_intron")
def p3_introns(spark, sf):
    return A.introns(v_exon(spark, sf)).select("tx", long("block"), "chrom", "strand", long("start"), long("end"))


_LEADS = 'SELECT *, lag("end") OVER w AS host_start, lead("start") OVER w AS host_end, lag("start") OVER w AS before FROM v_exon WINDOW w AS (PARTITION BY tx ORDER BY "start", block)'


@query(f'SELECT tx, CAST("start" AS BIGINT) AS "start", CAST("end" AS BIGINT) AS "end", CAST(host_start AS BIGINT) AS host_start, CAST(host_end AS BIGINT) AS host_end FROM ({_LEADS}) WHERE host_start IS NOT NULL AND host_end IS NOT NULL AND "end" - "start" <= 30', "v_exon")
def p4_triples(spark, sf):
    return A.triples(v_exon(spark, sf), 30).select("tx", long("start"), long("end"), long("host_start"), long("host_end"))


@query('SELECT tx, CAST(block AS BIGINT) AS block, CAST(sum("end" - "start") OVER (PARTITION BY tx ORDER BY "start", block ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tx_end FROM v_exon', "v_exon")
def w3_offsets(spark, sf):
    return A.offsets(v_exon(spark, sf)).select("tx", long("block"), long("tx_end"))


@query(f"SELECT tx, CAST(block AS BIGINT) AS block FROM ({_LEADS}) WHERE host_start IS NOT NULL AND host_end IS NOT NULL", "v_exon")
def f24_internal_exons(spark, sf):
    return A.internal(v_exon(spark, sf)).select("tx", long("block"))


@query('SELECT tx, CAST(block AS BIGINT) AS block, CAST(lag("start") OVER w AS BIGINT) AS prev_start, CAST(lag("end") OVER w AS BIGINT) AS prev_end FROM v_intron WINDOW w AS (PARTITION BY tx ORDER BY "start", block)', "v_intron")
def w9_prev_intron(spark, sf):
    return A.previous_intron(A.introns(v_exon(spark, sf))).select("tx", long("block"), long("prev_start"), long("prev_end"))


_ELIGIBLE = 'SELECT tx, block, chrom, strand, "end" AS "start", nxt AS "end", "end" - "start" AS up_len, nxt_end - nxt AS down_len FROM (SELECT *, lead("start") OVER w AS nxt, lead("end") OVER w AS nxt_end FROM v_exon WINDOW w AS (PARTITION BY tx ORDER BY "start", block)) WHERE "end" - "start" > 10 AND nxt_end - nxt > 10 AND nxt - "end" >= 80'


@query(f'SELECT tx, CAST(block AS BIGINT) AS block, CAST("start" AS BIGINT) AS "start", CAST("end" AS BIGINT) AS "end" FROM ({_ELIGIBLE})', "v_exon")
def f1_tag_filter(spark, sf):
    return A.eligible(v_exon(spark, sf), 10).select("tx", long("block"), long("start"), long("end"))


@query(f'SELECT chrom, strand, CAST("start" AS BIGINT) AS "start", CAST("end" AS BIGINT) AS "end", tx, CAST(block AS BIGINT) AS block FROM ({_ELIGIBLE}) QUALIFY row_number() OVER (PARTITION BY chrom, strand, "start", "end" ORDER BY up_len + down_len DESC, tx, block) = 1', "v_exon")
def a1_best_tag(spark, sf):
    return A.best_tags(A.eligible(v_exon(spark, sf), 10)).select("chrom", "strand", long("start"), long("end"), "tx", long("block"))


_GENOME = "SELECT 'chr' || CAST(doc_id AS VARCHAR) AS chrom, seq FROM v_dna"
_PARTS = f'SELECT e.*, substr(seq, "start" + 1, "end" - "start") AS part FROM v_exon e JOIN ({_GENOME}) g USING (chrom)'


def _genome(spark, sf) -> DataFrame:
    return v_dna(spark, sf).select(F.concat(F.lit("chr"), F.col("doc_id").cast("string")).alias("id"), "seq")


def _stranded_sql(x: str) -> str:
    return f"CASE WHEN strand = '-' THEN reverse(translate({x}, 'ACGT', 'TGCA')) ELSE {x} END"


_BESIDE = f"""SELECT tx, block, {_stranded_sql("(substr(seq, \"start\" - 1, 2) || substr(seq, \"end\" + 1, 2))")} AS dn FROM v_exon JOIN ({_GENOME}) g USING (chrom) WHERE "start" >= 2"""


@query(f"SELECT tx, CAST(block AS BIGINT) AS block, dn, dn = 'AGGT' AS flanked FROM ({_BESIDE})", "v_dna", "v_exon")
def p10_flank_dinuc(spark, sf):
    """The two bases in front of and behind each exon, as its strand reads them."""
    d = A.flank_dinucleotides(v_exon(spark, sf).where("start >= 2"), _genome(spark, sf))
    return d.select("tx", long("block"), F.col("beside").alias("dn"), (F.col("beside") == "AGGT").alias("flanked"))


_AT = f"""SELECT tx, block, strand, i."start" AS s, i."end" AS e, seq, CAST(1 + tx % 9 AS INTEGER) AS k FROM v_intron i JOIN ({_GENOME}) g USING (chrom)"""
_TRIPLE = f"""SELECT tx, block, substr(seq, greatest(s - 12, 0) + 1, least(s, 12)) AS up, substr(seq, s + 1, k) AS found, substr(seq, s + k + 1, 30) AS down FROM ({_AT}) WHERE length(seq) >= s + 40"""


@query(
    f"""SELECT tx, CAST(block AS BIGINT) AS block, CASE WHEN length(found) <= length(up) THEN length(found) + {_prefix_sql('reverse(up)', 'reverse(up || found)')} ELSE 0 END AS dru,
{_prefix_sql('(found || down)', 'down')} AS drd FROM ({_TRIPLE})""",
    "v_dna", "v_intron",
)
def p18_direct_repeat(spark, sf):
    """Insertions at the start of every intron: how far each may move either way."""
    s, k = F.col("start"), (1 + F.col("tx") % 9).cast("int")
    d = G.with_slices(A.introns(v_exon(spark, sf)), _genome(spark, sf), {"up": (F.greatest(s - 12, F.lit(0)), s), "rest": (s, s + 40)}).where("length(rest) = 40")
    d = d.select("tx", "block", "up", F.substr("rest", F.lit(1), k).alias("found"), F.substr("rest", k + 1, F.lit(30)).alias("down"))
    return d.select("tx", long("block"), S.direct_repeat_up(F.col("up"), F.col("found")).cast("long").alias("dru"), S.direct_repeat_down(F.col("down"), F.col("found")).cast("long").alias("drd"))


@query(f"SELECT tx, CAST(block AS BIGINT) AS block, coalesce(nullif(substr(substr(seq, s + 1, e - s), CAST(tx % 90 + 1 AS INTEGER), 7), ''), 'ACGTACG') AS moved FROM ({_AT})", "v_dna", "v_intron")
def p19_reanchor(spark, sf):
    d = G.with_slices(A.introns(v_exon(spark, sf)), _genome(spark, sf), {"read": (F.col("start"), F.col("end"))})
    return d.select("tx", long("block"), D.reanchor(F.lit("ACGTACG"), F.col("tx") % 90, F.lit(0), F.col("read")).alias("moved"))


_WINDOWS = f"""w AS (SELECT tx, block, CASE WHEN strand = '-' THEN CASE WHEN "end" >= 3 THEN reverse(translate(substr(seq, "end" - 2, 17), 'ACGT', 'TGCA')) ELSE '' END WHEN "start" >= 14 THEN substr(seq, "start" - 13, 17) ELSE '' END AS acceptor,
    CASE WHEN strand = '-' THEN CASE WHEN "start" >= 10 THEN reverse(translate(substr(seq, "start" - 9, 13), 'ACGT', 'TGCA')) ELSE '' END WHEN "end" >= 3 THEN substr(seq, "end" - 2, 13) ELSE '' END AS donor
  FROM ({_LEADS}) x JOIN ({_GENOME}) g USING (chrom) WHERE host_start IS NOT NULL AND host_end IS NOT NULL),
z AS (SELECT tx, block, site, i AS pos, substr(s, CAST(i + 1 AS INTEGER), 1) AS nt, learns FROM (SELECT *, length(acceptor) >= 5 AND substr(donor, 4, 2) || substr(acceptor, greatest(length(acceptor) - 4, 1), 2) = 'GTAG' AS learns FROM w)
  UNPIVOT (s FOR site IN (acceptor, donor)), range(0, 17) t(i) WHERE i < length(s)),
m AS (SELECT site, pos, """ + ", ".join(f"count(*) FILTER (WHERE nt = '{c}') / count(*) AS {c.lower()}" for c in "ACGT") + " FROM z WHERE learns AND nt IN ('A', 'C', 'G', 'T') GROUP BY site, pos)"


def _learned(spark, sf) -> DataFrame:
    return A.learn_matrices(v_exon(spark, sf), _genome(spark, sf))


@query(f"WITH {_WINDOWS} SELECT site, CAST(pos AS BIGINT) AS pos, round(a, 6) AS a, round(c, 6) AS c, round(g, 6) AS g, round(t, 6) AS t FROM m", "v_dna", "v_exon")
def a16_pwm_learn(spark, sf):
    """Shares by position of 17 bases over the first and 13 over the last border of all internal exons between AG and GT."""
    return _learned(spark, sf).select("site", F.col("pos").cast("long").alias("pos"), *(F.round(F.col(c), 6).alias(c.lower()) for c in "ACGT"))


@query(f"WITH {_WINDOWS} SELECT count(*) AS positions, round(sum(greatest(a, c, g, t)), 6) AS best FROM m", "v_dna", "v_exon")
def p23_pwm_max(spark, sf):
    """The largest sum that an exon's two windows can reach together."""
    return _learned(spark, sf).agg(F.count("*").alias("positions"), F.round(F.sum(F.greatest(*"ACGT")), 6).alias("best"))


@query(
    f"""WITH {_WINDOWS}, u AS (SELECT * FROM m UNPIVOT (share FOR letter IN (a, c, g, t))), s AS (SELECT tx, block, sum(share) AS s FROM z JOIN u ON u.site = z.site AND u.pos = z.pos AND upper(u.letter) = nt GROUP BY ALL)
SELECT tx, CAST(block AS BIGINT) AS block, round(coalesce(100 * s.s / (SELECT sum(greatest(a, c, g, t)) FROM m), 0), 6) AS u2 FROM w LEFT JOIN s USING (tx, block)""",
    "v_dna", "v_exon",
)
def p22_pwm_score(spark, sf):
    """Splice score of every internal exon: both windows by the learned matrices, in percent of their joint maximum."""
    e, genome = v_exon(spark, sf), _genome(spark, sf)
    acceptor, donor = A.collected(A.learn_matrices(e, genome))
    inner = A.internal(e).select("tx", "block", "chrom", "strand", "start", "end")
    return A.splice_scores(inner, genome, acceptor, donor).select("tx", long("block"), F.round("u2", 6).alias("u2"))


@query(f"WITH {_WINDOWS} SELECT CAST(pos AS BIGINT) AS pos, a, c, g, t FROM m WHERE site = 'donor'", "v_dna", "v_exon")
def s9_weight_matrix(spark, sf):
    """The learned donor matrix, written as a headered table and read again."""
    path = shared_folder(spark, "matrix")
    _learned(spark, sf).where("site = 'donor'").coalesce(1).sortWithinPartitions("pos").select(*"ACGT").write.option("sep", "\t").option("header", True).csv(path)
    got = IO.weight_matrix(spark, path)
    return spark.createDataFrame([(i, m["A"], m["C"], m["G"], m["T"]) for i, m in enumerate(got)], "pos long, a double, c double, g double, t double")


_TILED = """g AS (SELECT 'chr' || CAST(doc_id % 25 AS VARCHAR) AS chrom, string_agg(seq, '' ORDER BY doc_id) AS seq FROM v_dna GROUP BY 1)"""


@query(
    f"""WITH {_TILED} SELECT tx, CAST(block AS BIGINT) AS block, md5(s) AS digest, CAST(length(s) AS BIGINT) AS n
FROM (SELECT tx, block, substr(seq, CAST("start" * 20 + 1 AS INTEGER), CAST(50 + tx % 7 * 400 AS INTEGER)) AS s FROM v_exon e JOIN g ON g.chrom = 'chr' || CAST(tx % 25 AS VARCHAR))""",
    "v_dna", "v_exon",
)
def p7_tiled_slices(spark, sf):
    """Slices over several tiles each of 25 long chromosomes, which are read from FASTA lines and never assembled."""
    path = shared_folder(spark, "genome")
    d = v_dna(spark, sf).withColumn("chrom", (F.col("doc_id") % 25).cast("string"))
    heads = table(spark, sf, "documents").groupBy((F.col("doc_id") % 25).cast("string").alias("chrom")).agg(F.min("doc_id").alias("head"))
    lines = d.join(F.broadcast(heads), "chrom").withColumn("first", F.col("doc_id") == F.col("head")).repartition("chrom").sortWithinPartitions("chrom", "doc_id")
    body = F.regexp_replace(F.lower("seq"), "(.{70})", "$1\n")
    lines.select(F.when(F.col("first"), F.concat(F.lit(">chr"), "chrom", F.lit(" more\n"), body)).otherwise(body)).write.text(path)
    tiles = IO.fasta_tiles(spark, path, 1024)
    at = v_exon(spark, sf).select("tx", "block", F.concat(F.lit("chr"), (F.col("tx") % 25).cast("string")).alias("chrom"), (F.col("start") * 20).alias("s"))
    out = G.with_slices(at, tiles, {"cut": (F.col("s"), F.col("s") + 50 + F.col("tx") % 7 * 400)}, 1024)
    return out.select("tx", long("block"), F.md5("cut").alias("digest"), F.length("cut").cast("long").alias("n"))


_TX = f"SELECT tx, strand, CASE WHEN strand = '-' THEN reverse(translate(s, 'ACGT', 'TGCA')) ELSE s END AS seq FROM (SELECT tx, strand, string_agg(part, '' ORDER BY \"start\") AS s FROM ({_PARTS}) GROUP BY tx, strand)"


@query(f"SELECT tx, seq FROM ({_TX})", "v_dna", "v_exon")
def p5_transcript_seq(spark, sf):
    return A.transcript_sequences(v_exon(spark, sf), _genome(spark, sf))


@query(
    f"""WITH t AS ({_TX}), e AS (SELECT *, lead("start") OVER w AS nxt, sum("end" - "start") OVER (w ROWS UNBOUNDED PRECEDING) AS done, sum("end" - "start") OVER (PARTITION BY tx) AS total FROM v_exon WINDOW w AS (PARTITION BY tx ORDER BY "start", block)),
x AS (SELECT *, CASE WHEN strand = '-' THEN total - done ELSE done END AS pos FROM e WHERE nxt IS NOT NULL)
SELECT x.tx, CAST(block AS BIGINT) AS junction, CAST(least(pos, 15) AS BIGINT) AS up, substr(seq, CAST(pos - least(pos, 15) + 1 AS INTEGER), CAST(least(pos, 15) + least(total - pos, 15) AS INTEGER)) AS tag FROM x JOIN t ON t.tx = x.tx""",
    "v_dna", "v_exon",
)
def p6_junction_tag(spark, sf):
    e = v_exon(spark, sf)
    return A.junction_tags(e, A.transcript_sequences(e, _genome(spark, sf)), 15).select("tx", long("junction"), "up", "tag")


@query(f'SELECT tx, CAST(block AS BIGINT) AS block, right(string_agg(part, \'\') OVER (PARTITION BY tx ORDER BY "start", block ROWS UNBOUNDED PRECEDING), 100) AS flank FROM ({_PARTS})', "v_dna", "v_exon")
def w4_running_flank(spark, sf):
    parts = A.exon_parts(v_exon(spark, sf), _genome(spark, sf))
    return A.running_flanks(parts).select("tx", long("block"), "flank")


@query(
    f"""SELECT tx, CAST(block AS BIGINT) AS block, CASE WHEN strand = '-' THEN reverse(translate(t, 'ACGT', 'TGCA')) ELSE t END AS tag FROM (
SELECT tx, block, strand, right(string_agg(part, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 100) || part || left(string_agg(part, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 100) AS t
FROM ({_PARTS}) WINDOW w AS (PARTITION BY tx ORDER BY "start", block)) WHERE t IS NOT NULL""",
    "v_dna", "v_exon",
)
def p27_me_tag(spark, sf):
    parts = A.exon_parts(v_exon(spark, sf), _genome(spark, sf))
    return A.me_tags(parts).select("tx", long("block"), "tag")


@query('SELECT chrom, strand, CAST("start" AS BIGINT) AS "start", string_agg(DISTINCT CAST(tx AS VARCHAR), \',\' ORDER BY CAST(tx AS VARCHAR)) AS transcripts, min(CAST(tx AS VARCHAR)) AS tx FROM v_exon GROUP BY ALL', "v_exon")
def a9_first_transcript(spark, sf):
    return A.first_transcript(v_exon(spark, sf).withColumn("tx", F.col("tx").cast("string")), ["chrom", "strand", "start"]).withColumn("start", F.col("start").cast("long"))


@query(f"SELECT e.tx, CAST(e.block AS BIGINT) AS block, CAST(length(g.seq) AS BIGINT) AS size FROM v_exon e JOIN ({_GENOME}) g USING (chrom)", "v_dna", "v_exon")
def j2_chrom_join(spark, sf):
    return v_exon(spark, sf).join(IO.chrom_sizes(_genome(spark, sf)), "chrom").select("tx", long("block"), "size")


# reads ----------------------------------------------------------------------------------------------------------------------------------


@query("SELECT read, line, tag, supp, CAST(score AS BIGINT) AS ins_at, CAST(line AS BIGINT) AS ins_len FROM v_align WHERE contains(cigar, 'I')", "v_align")
def f3_one_insertion(spark, sf):
    return D.one_insertion(v_align(spark, sf)).select("read", "line", "tag", "supp", long("ins_at"), long("ins_len"))


@query("SELECT read, line, tag, supp FROM v_align WHERE contains(cigar, 'I') AND 25 BETWEEN score - line AND score + supp % 7", "v_align")
def f4_repeat_window(spark, sf):
    d = D.one_insertion(v_align(spark, sf)).withColumns({"up": F.lit(25), "dru": F.col("line"), "drd": F.col("supp") % 7})
    return D.in_repeat_window(d).select("read", "line", "tag", "supp")


@query("SELECT read, count(*) AS n FROM v_align WHERE read IN (SELECT read FROM v_align GROUP BY read HAVING count(DISTINCT supp) = 1) GROUP BY read", "v_align")
def f5_unique_intron(spark, sf):
    return D.unique_intron(v_align(spark, sf), intron="supp").groupBy("read").agg(F.count("*").alias("n"))


@query("SELECT read, line, tag, supp FROM v_align WHERE \"start\" <= 400 - 8 AND supp % 5 = 0 AND line <= 5", "v_align")
def f7_read_filter(spark, sf):
    return D.read_filter(v_align(spark, sf).withColumn("up", F.lit(400)), 5).select("read", "line", "tag", "supp")


@query(r"SELECT read, line, tag, supp FROM v_align WHERE flag & 4 = 0 AND regexp_full_match(cigar, '\d+M')", "v_align")
def f9_ungapped(spark, sf):
    return Q.ungapped(v_align(spark, sf)).select("read", "line", "tag", "supp")


_OVER = '("start" <= {at} - 8 AND "start" + score >= {at} + 8)'


def _tagged(spark, sf) -> DataFrame:
    return v_align(spark, sf).withColumns({"matched": F.col("score"), "up": F.lit(300), "me_len": F.when(F.col("supp") % 2 == 0, F.col("line")), "seq": F.col("tag").cast("string")})


@query(f"SELECT read, line, tag, supp FROM v_align WHERE {_OVER.format(at=300)} OR (supp % 2 = 0 AND {_OVER.format(at='(300 + line)')})", "v_align")
def f10_anchor8(spark, sf):
    return Q.anchored(_tagged(spark, sf)).select("read", "line", "tag", "supp")


@query(
    f"""SELECT tag, count(*) AS reads, count(*) FILTER (WHERE u) AS up_reads, count(*) FILTER (WHERE d) AS down_reads, count(DISTINCT CASE WHEN u OR d THEN read END) AS distinct_seqs FROM (
SELECT *, supp % 2 = 0 AND {_OVER.format(at=300)} AS u, supp % 2 = 0 AND NOT {_OVER.format(at=300)} AND {_OVER.format(at='(300 + line)')} AS d FROM v_align) GROUP BY tag""",
    "v_align",
)
def a10_tag_counts(spark, sf):
    return Q.tag_counts(_tagged(spark, sf).withColumn("seq", F.col("read")))


@query("SELECT flag, count(*) AS n FROM v_align WHERE flag IN (0, 16) GROUP BY flag", "v_align")
def f11_flag(spark, sf):
    return v_align(spark, sf).where(F.col("flag").isin(0, 16)).groupBy("flag").agg(F.count("*").alias("n"))


@query("SELECT read, CAST(score AS BIGINT) AS score, CAST(row AS BIGINT) AS row FROM (SELECT read, score, tag * 10 + line AS row FROM v_align) QUALIFY row_number() OVER (PARTITION BY read ORDER BY score DESC, row) = 1", "v_align")
def a3_best_alignment(spark, sf):
    d = v_align(spark, sf).select("read", "score", (F.col("tag") * 10 + F.col("line")).alias("row"))
    return D.best_alignment(d).select("read", long("score"), "row")


@query(
    """WITH g AS (SELECT read, max(score) AS g_score, max(supp) AS g_supp FROM v_align JOIN orders ON o_orderkey = read WHERE o_orderstatus = 'F' GROUP BY read)
SELECT a.read, line, tag, a.supp FROM v_align a LEFT JOIN g USING (read) WHERE g_score IS NULL OR g_supp = a.supp OR a.score > g_score""",
    "v_align",
)
def f8_competition(spark, sf):
    d = v_align(spark, sf)
    hits = d.join(table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("long").alias("read")), "read", "left_semi")
    g = hits.groupBy("read").agg(F.max("score").alias("g_score"), F.max("supp").alias("g_supp"))
    both = d.join(g, "read", "left").withColumns({"same_me": F.col("g_supp") == F.col("supp"), "t_score": F.col("score")}).drop("g_score", "g_supp")
    same = both.groupBy("read", "supp").agg(F.max("same_me").alias("same_me"))
    reads = d.withColumn("t_score", F.col("score"))
    keep = D.genome_competition(reads.join(same, ["read", "supp"]), g.drop("g_supp"))
    return keep.select("read", "line", "tag", "supp")


@query("SELECT tag, supp, count(DISTINCT read) AS coverage FROM v_align GROUP BY tag, supp", "v_align")
def a4_distinct_coverage(spark, sf):
    return D.coverage(v_align(spark, sf).withColumn("seq", F.col("read")), ["tag", "supp"])


_SETS = "WITH d AS (SELECT DISTINCT read AS k, tag AS i FROM v_align)"


@query(f"{_SETS} SELECT DISTINCT array_to_string(keys, ',') AS keys FROM (SELECT a.k, list_sort(list(DISTINCT b.k)) AS keys FROM d a JOIN d b USING (i) GROUP BY a.k)", "v_align")
def a5_neighbour_sets(spark, sf):
    return D.neighbour_sets(v_align(spark, sf), "read", "tag").select(F.array_join(F.transform("keys", lambda x: x.cast("string")), ",").alias("keys"))


@query("SELECT supp, array_to_string(list_sort(list_reduce(list(s ORDER BY tag), lambda a, b: list_intersect(a, b))), ',') AS common FROM (SELECT supp, tag, list(DISTINCT line) AS s FROM v_align GROUP BY supp, tag) GROUP BY supp", "v_align")
def a6_intersection(spark, sf):
    d = v_align(spark, sf).groupBy("supp", "tag").agg(F.array_sort(F.collect_set("line")).alias("s")).groupBy("supp").agg(F.collect_list("s").alias("s"))
    return d.select("supp", F.array_join(F.transform(D.intersect_sets(F.col("s")), lambda x: x.cast("string")), ",").alias("common"))


@query("SELECT read, CAST(max(score) AS BIGINT) AS u2, CAST(arg_max(tag, CAST(score AS BIGINT) * 1000000000 + tag) AS BIGINT) AS me FROM v_align GROUP BY read", "v_align")
def a7_argmax(spark, sf):
    return v_align(spark, sf).groupBy("read").agg(F.max(F.struct("score", "tag")).alias("b")).select("read", F.col("b.score").cast("long").alias("u2"), F.col("b.tag").alias("me"))


@query(f"WITH c AS ({_CUT}) SELECT chrom, CAST(g[1] AS BIGINT) AS \"start\", CAST(g[2] AS BIGINT) AS \"end\", count(*) AS n FROM (SELECT chrom, unnest(list_transform(range(1, len(b)), lambda i: [b[i][2], b[i + 1][1]])) AS g FROM c) GROUP BY ALL", "v_align")
def a17_intron_counts(spark, sf):
    return R.junction_counts(v_align(spark, sf)).select("chrom", long("start"), long("end"), "n")


@query(f"WITH c AS ({_CUT}) SELECT chrom, CAST(b[2][1] AS BIGINT) AS \"start\", CAST(b[2][2] AS BIGINT) AS \"end\", count(*) AS n FROM c WHERE len(b) >= 3 GROUP BY ALL", "v_align")
def a18_exon_counts(spark, sf):
    return R.exon_counts(v_align(spark, sf)).select("chrom", long("start"), long("end"), "n")


@query(
    f"""WITH c AS ({_CUT}), e AS (SELECT chrom, unnest(b) AS x FROM c), v AS (SELECT chrom, x[1] AS pos, 1 AS d FROM e UNION ALL SELECT chrom, x[2], -1 FROM e), s AS (SELECT chrom, pos, sum(d) AS d FROM v GROUP BY ALL)
SELECT chrom, CAST(pos AS BIGINT) AS pos, CAST(depth AS BIGINT) AS depth FROM (SELECT chrom, pos, d, sum(d) OVER (PARTITION BY chrom ORDER BY pos ROWS UNBOUNDED PRECEDING) AS depth FROM s) WHERE d <> 0""",
    "v_align",
)
def p41_base_coverage(spark, sf):
    return R.base_coverage(v_align(spark, sf)).select("chrom", long("pos"), "depth")


@query("SELECT flag, CASE WHEN (CASE WHEN flag & 128 <> 0 THEN flag & 16 <> 0 ELSE flag & 16 = 0 END) THEN '+' ELSE '-' END AS mate1, CASE WHEN (CASE WHEN flag & 64 <> 0 THEN flag & 16 <> 0 ELSE flag & 16 = 0 END) THEN '+' ELSE '-' END AS mate2, CASE WHEN flag & 16 <> 0 THEN '+' ELSE '-' END AS antisense, count(*) AS n FROM v_align GROUP BY flag", "v_align")
def p42_strand_flip(spark, sf):
    d = v_align(spark, sf).groupBy("flag").agg(F.count("*").alias("n"))
    of = lambda p: C.protocol_strand(F.col("flag"), p)
    return d.select("flag", of("MATE1_SENSE").alias("mate1"), of("MATE2_SENSE").alias("mate2"), of("ANTISENSE").alias("antisense"), "n")


_EXOTIC = [(0, "'5H' || cigar", lambda c: F.concat(F.lit("5H"), c)), (1, "cigar || '3X'", lambda c: F.concat(c, F.lit("3X"))), (2, "cigar || '2P'", lambda c: F.concat(c, F.lit("2P"))), (3, "'7=' || cigar", lambda c: F.concat(F.lit("7="), c))]


@query(f"WITH x AS (SELECT *, CASE line {' '.join(f'WHEN {k} THEN {sql}' for k, sql, _ in _EXOTIC)} ELSE cigar END AS written FROM ({_CUT})) SELECT read, line, tag, supp, CAST(len(b) AS BIGINT) AS blocks FROM x WHERE NOT regexp_matches(written, '[HPX=]')", "v_align")
def f23_cigar_ops(spark, sf):
    """Reads with an operation of H, P, X or = are left out of the blocks."""
    cigar = F.col("cigar")
    for k, _, of in _EXOTIC:
        cigar = F.when(F.col("line") == k, of(F.col("cigar"))).otherwise(cigar)
    return R.blocks_of(v_align(spark, sf).withColumn("cigar", cigar)).select("read", "line", "tag", "supp", F.size("blocks").cast("long").alias("blocks"))


@query("SELECT page_id, CAST(len(string_split(url, '/')) AS BIGINT) AS n FROM pages WHERE len(string_split(url, '/')) = 5")
def f6_arity(spark, sf):
    d = table(spark, sf, "pages").select("page_id", F.split("url", "/").alias("f"))
    return d.where(F.size("f") == 5).select("page_id", F.size("f").cast("long").alias("n"))


@query("SELECT doc_id, 1 AS mate, substr(text, 1, length(text) // 2) AS seq FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, 2, substr(text, length(text) // 2 + 1) FROM documents WHERE text IS NOT NULL")
def s17_split_pairs(spark, sf):
    d = table(spark, sf, "documents").where("text is not null").select(F.col("doc_id").alias("id"), F.col("text").alias("seq"), F.col("text").alias("qual"))
    return IO.split_pairs(d).select(F.col("id").alias("doc_id"), "mate", "seq")


@query("SELECT CAST(doc_id AS VARCHAR) || '_1' AS id, text FROM documents UNION ALL SELECT CAST(doc_id AS VARCHAR) || '_2', lower(text) FROM documents")
def s16_merge_pairs(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return IO.merge_mates(d, d.withColumn("text", F.lower("text")))


@query("SELECT doc_id, rpad(substr(lang || lang || lang, 1, CAST(n_chars % 9 AS INTEGER)), CAST(n_chars % 9 AS INTEGER), '#') AS qual FROM documents")
def p45_qual_repair(spark, sf):
    d = table(spark, sf, "documents").withColumns({"seq": F.substr("text", F.lit(1), (F.col("n_chars") % 9).cast("int")), "q": F.concat("lang", "lang", "lang")})
    return d.select("doc_id", S.repair_quality(F.col("seq"), F.col("q")).alias("qual"))


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(text) = n_chars")
def s8_valid_reads(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("seq"), F.rpad(F.lit(""), F.col("n_chars").cast("int"), F.lit("I")).alias("qual"))
    return IO.valid_reads(d).select("doc_id", F.length("seq").cast("long").alias("n"))


@query("SELECT chrom || '_' || strand || '_' || \"start\" || '_' || \"end\" AS me, chrom || ':' || (\"start\" + 1) || '-' || \"end\" AS coord, chrom, CAST(\"end\" AS BIGINT) AS stop FROM v_exon", "v_exon")
def p32_coord(spark, sf):
    d = v_exon(spark, sf).withColumn("me", K.me_id(F.col("chrom"), F.col("strand"), F.col("start"), F.col("end")))
    back = K.parse_me(F.col("me"))
    return d.select("me", K.coordinate(back["chrom"], back["start"], back["end"]).alias("coord"), back["chrom"].alias("chrom"), back["end"].cast("long").alias("stop"))


@query("SELECT tx, CAST(block AS BIGINT) AS block, chrom, CAST(\"start\" - 1 AS BIGINT) AS \"from\", CAST(\"end\" * 1000 AS BIGINT) AS \"to\" FROM v_exon WHERE \"start\" >= 1", "v_exon")
def p44_region_parse(spark, sf):
    d = v_exon(spark, sf).where("start >= 1")
    r = K.parse_region(F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"), F.lit(",000")))
    return d.select("tx", long("block"), r["chrom"].alias("chrom"), r["start"].alias("from"), r["end"].alias("to"))


@query("SELECT DISTINCT replace(c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR), ' ', '_') AS name FROM customer")
def p46_name_norm(spark, sf):
    return table(spark, sf, "customer").select(K.plain_name(F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string"))).alias("name")).distinct()


@query('SELECT chrom, strand, CAST("start" AS BIGINT) AS "start", max(tx) AS tx FROM v_exon GROUP BY ALL', "v_exon")
def w5_last_wins(spark, sf):
    w = Window.partitionBy("chrom", "strand", "start").orderBy(F.col("tx").desc())
    return v_exon(spark, sf).withColumn("r", F.row_number().over(w)).where("r = 1").select("chrom", "strand", long("start"), "tx")
