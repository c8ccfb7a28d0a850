"""Queries on readers and writers: a view is written to the shared folder in the reader's format and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import annotation as A
from ..operators import isoforms as G
from ..sources import bam as B
from ..sources import bigwig as W
from ..sources import gz as Z
from ..sources import text as IO
from ..sources.shared import shared_folder
from .quantification import _GENES, _genes
from .registry import query, table, v_align, v_cov, v_dna, v_exon
from .sequences import _CUT


def long(c: str):
    return F.col(c).cast("long").alias(c)


def _lines(spark, df: DataFrame, *columns, gz: bool = False) -> str:
    """Writes tab-separated lines and returns their folder."""
    path = shared_folder(spark, "lines")
    df.select(F.concat_ws("\t", *columns)).write.option("compression", "gzip" if gz else "none").text(path)
    return path


def _fasta(spark, sf, head) -> str:
    path = shared_folder(spark, "fasta")
    IO.write_fasta(v_dna(spark, sf).select(head.alias("id"), F.lower("seq").alias("seq")), path)
    return path


@query("SELECT 'chr' || doc_id AS id, seq FROM v_dna", "v_dna")
def s1_fasta(spark, sf):
    """Headers hold blanks and the record sign."""
    return IO.fasta(spark, _fasta(spark, sf, F.concat(F.lit("chr"), F.col("doc_id").cast("string"), F.lit(" a>b >c"))))


@query("SELECT 'tx' || doc_id AS id, seq FROM v_dna", "v_dna")
def s2_transcripts(spark, sf):
    return IO.transcripts(spark, _fasta(spark, sf, F.concat(F.lit("tx"), F.col("doc_id").cast("string"), F.lit("|gene|more"))))


@query("SELECT 'chr' || doc_id AS chrom, CAST(length(seq) AS BIGINT) AS size FROM v_dna", "v_dna")
def s3_chrom_sizes(spark, sf):
    return IO.chrom_sizes(IO.fasta(spark, _fasta(spark, sf, F.concat(F.lit("chr"), F.col("doc_id").cast("string")))))


@query(
    """SELECT CAST(tx AS VARCHAR) AS name, chrom, strand, CAST(min("start") AS BIGINT) AS "start", CAST(max("end") AS BIGINT) AS "end", count(*) AS blocks, string_agg(CAST("end" - "start" AS VARCHAR), ';' ORDER BY "start", "end") AS sizes,
string_agg(CAST("start" - first AS VARCHAR), ';' ORDER BY "start", "end") AS starts FROM (SELECT *, min("start") OVER (PARTITION BY tx) AS first FROM v_exon) GROUP BY tx, chrom, strand""",
    "v_exon",
)
def s4_bed12(spark, sf):
    """Comma lists end in a comma."""
    b = A.exons_bed12(v_exon(spark, sf))
    zero, listed = F.lit("0"), lambda c: F.concat(c, F.lit(","))
    path = _lines(spark, b, "chrom", "start", "end", "name", zero, "strand", "start", "end", zero, "block_count", listed("block_sizes"), listed("block_starts"))
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ";").alias(c[6:])
    return IO.bed12(spark, path).select("name", "chrom", "strand", long("start"), long("end"), F.col("block_count").cast("long").alias("blocks"), join("block_sizes"), join("block_starts"))


@query(f'WITH {_GENES} SELECT \'exon\' AS feature, chrom, strand, CAST("start" AS BIGINT) AS "start", CAST("end" AS BIGINT) AS "end", gene, tx FROM x', "v_exon")
def s5_gtf(spark, sf):
    path = shared_folder(spark, "gtf")
    IO.write_gtf(G.gtf_rows(_genes(spark, sf)), path)
    return IO.gtf(spark, path).where("feature = 'exon'").select("feature", "chrom", "strand", long("start"), long("end"), "gene", "tx")


def _sam_fields() -> list:
    return ["read", "flag", "chrom", F.col("start") + 1, F.lit("60"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), F.concat(F.lit("AS:i:"), F.col("score").cast("string")), F.concat(F.lit("XA:Z:"), F.col("tag").cast("string"))]


@query("SELECT CAST(read AS VARCHAR) AS read, CAST(flag AS BIGINT) AS flag, chrom, CAST(\"start\" AS BIGINT) AS \"start\", cigar, CAST(score AS BIGINT) AS score, CAST(tag AS VARCHAR) AS others FROM v_align", "v_align")
def s6_sam(spark, sf):
    """Header lines and a line of few fields stand among the alignments."""
    d = v_align(spark, sf)
    path = shared_folder(spark, "sam")
    lines = d.select(F.concat_ws("\t", *_sam_fields()).alias("value"))
    short = spark.createDataFrame([("@HD\tVN:1.6",), ("@SQ\tSN:chr1\tLN:9",), ("too\tshort",)], "value string")
    short.unionByName(lines).write.text(path)
    got = IO.sam(spark, path)
    return got.select("read", long("flag"), F.col("tag").alias("chrom"), long("start"), "cigar", long("score"), "others")


@query("SELECT 'd' || doc_id AS id, seq, lower(seq) AS qual FROM v_dna WHERE seq <> ''", "v_dna")
def s7_fastq(spark, sf):
    """Written gzipped, read as records of four lines."""
    path = shared_folder(spark, "fastq")
    IO.write_fastq(v_dna(spark, sf).where("seq <> ''").select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(" more")).alias("id"), "seq", F.lower("seq").alias("qual")), path)
    return IO.valid_reads(IO.fastq(spark, path)).select("id", "seq", "qual")


@query(
    """WITH v AS (SELECT DISTINCT chrom, "start" AS rs, "end" AS re, "start" % 10 AS value FROM v_exon WHERE "end" - "start" > 25), r AS (SELECT DISTINCT chrom, "start" - 2 AS s, "end" + 2 AS e, "start" AS a, "end" AS b FROM v_exon WHERE "end" - "start" <= 10),
h AS (SELECT r.chrom, a, b, sum(value * (least(e, re) - greatest(s, rs))) / sum(least(e, re) - greatest(s, rs)) AS mean FROM r JOIN v ON v.chrom = r.chrom AND s < re AND rs < e GROUP BY ALL)
SELECT r.chrom || '_' || a || '_' || b AS me, CAST(coalesce(floor(mean * 1000), 0) AS BIGINT) AS mean FROM r LEFT JOIN h USING (chrom, a, b)""",
    "v_exon",
)
def s10_range_mean(spark, sf):
    """Values are written and read as a bedGraph; regions without any have 0."""
    e = v_exon(spark, sf)
    path = _lines(spark, e.where("end - start > 25").select("chrom", "start", "end", (F.col("start") % 10).alias("value")).distinct(), "chrom", "start", "end", "value")
    mes = e.where("end - start <= 10").select("chrom", "start", "end").distinct().withColumn("me", F.concat_ws("_", "chrom", "start", "end"))
    return IO.conservation(mes, IO.bedgraph(spark, path), ["me"]).select("me", F.floor(F.col("mean") * 1000).cast("long").alias("mean"))


@query(
    """WITH v AS (SELECT DISTINCT chrom, "start" AS rs, "end" AS re, "start" % 10 AS value FROM v_exon WHERE "end" - "start" > 25), z AS (SELECT chrom, max("end") AS size FROM v_exon GROUP BY chrom),
r AS (SELECT DISTINCT chrom, "start" - 2 AS s, "end" + 2 AS e, "start" AS a, "end" AS b FROM v_exon WHERE "end" - "start" <= 10),
h AS (SELECT r.chrom, a, b, sum(value * (least(e, re) - greatest(s, rs))) / sum(least(e, re) - greatest(s, rs)) AS mean FROM r JOIN v ON v.chrom = r.chrom AND s < re AND rs < e JOIN z ON z.chrom = r.chrom AND s >= 0 AND e <= size GROUP BY ALL)
SELECT r.chrom || '_' || a || '_' || b AS me, CAST(coalesce(floor(mean * 1000), 0) AS BIGINT) AS mean FROM r LEFT JOIN h USING (chrom, a, b)""",
    "v_exon",
)
def s10_bigwig_mean(spark, sf):
    """Values are written and read as bigWig files, of which only the touched blocks are decoded; regions that leave their chromosome have 0."""
    e = v_exon(spark, sf)
    path = shared_folder(spark, "bigwig")
    W.write_bigwig(e.where("end - start > 25").select("chrom", "start", "end", (F.col("start") % 10).alias("value")).distinct(), e.groupBy("chrom").agg(F.max("end").alias("size")), path)
    mes = e.where("end - start <= 10").select("chrom", "start", "end").distinct().withColumn("me", F.concat_ws("_", "chrom", "start", "end"))
    return W.conservation(spark, mes, path, ["me"]).select("me", F.floor(F.col("mean") * 1000).cast("long").alias("mean"))


@query("SELECT CAST(sample AS VARCHAR) AS sample, me, CAST(inc AS VARCHAR) AS inc, CAST(skip AS VARCHAR) AS skip FROM v_cov", "v_cov")
def s11_table(spark, sf):
    path = shared_folder(spark, "table")
    v_cov(spark, sf).write.option("sep", "\t").option("header", True).csv(path)
    return IO.table(spark, path).select("sample", "me", "inc", "skip")


@query("SELECT CAST(sample AS VARCHAR) AS sample, me, CAST(inc AS VARCHAR) AS inc, CAST(skip AS VARCHAR) AS skip FROM v_cov", "v_cov")
def s12_gz_report(spark, sf):
    """A gzipped report, a folder for each sample's last digit."""
    path = shared_folder(spark, "report")
    IO.write_report(v_cov(spark, sf).withColumn("digit", F.col("sample") % 10), path, "digit")
    return IO.table(spark, path).select("sample", "me", "inc", "skip")


@query("SELECT CAST(sample AS VARCHAR) AS sample, me, CAST(inc AS VARCHAR) AS inc, CAST(skip AS VARCHAR) AS skip FROM v_cov", "v_cov")
def s12_gz_members(spark, sf):
    """The same report as one folder of gzip files, cut at members and read by many tasks."""
    path = shared_folder(spark, "members")
    IO.write_report(v_cov(spark, sf).repartition(4, "sample"), path)
    return Z.gz_table(spark, path, 1 << 14).select("sample", "me", "inc", "skip")


@query("SELECT 'd' || doc_id AS id, seq, lower(seq) AS qual FROM v_dna WHERE seq <> ''", "v_dna")
def s7_fastq_members(spark, sf):
    """Gzipped FASTQ through the reader that cuts at members."""
    path = shared_folder(spark, "fastq")
    IO.write_fastq(v_dna(spark, sf).where("seq <> ''").select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(" more")).alias("id"), "seq", F.lower("seq").alias("qual")), path)
    return IO.fastq(spark, path, members=True, split_bytes=1 << 18).select("id", "seq", "qual")


_LISTS = """SELECT 'A' || c_custkey AS sample, 'accession' AS origin, 'A' || c_custkey AS location FROM customer WHERE c_nationkey < 10 UNION SELECT 'L' || c_custkey, 'local', '/data/' || c_custkey || '.fastq' FROM customer
UNION SELECT 'U' || c_custkey, 'url', 'http://host/' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN '.fastq.gz' ELSE '.fastq.bz2' END FROM customer UNION SELECT 'C' || c_custkey, 'cram', '/cram/' || c_custkey || '.cram' FROM customer"""


def _samples(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("k"), (F.col("c_custkey") % 2 == 0).alias("even"), "c_nationkey")
    put = lambda letter, column, location: _table(spark, c.select(F.concat(F.lit(letter), "k").alias("sample"), location.alias(column)))
    listed = _lines(spark, c.where("c_nationkey < 10"), F.concat(F.lit("A"), "k"))
    ending = F.when(F.col("even"), ".fastq.gz").otherwise(".fastq.bz2")
    return IO.samples(spark, listed, put("L", "path", F.concat(F.lit("/data/"), "k", F.lit(".fastq"))), put("U", "url", F.concat(F.lit("http://host/"), "k", ending)), put("C", "path", F.concat(F.lit("/cram/"), "k", F.lit(".cram"))))


def _table(spark, df: DataFrame) -> str:
    path = shared_folder(spark, "list")
    df.write.option("sep", "\t").option("header", True).csv(path)
    return path


@query(_LISTS)
def s13_samples(spark, sf):
    """All four kinds of lists."""
    return _samples(spark, sf)


@query(f"SELECT sample, CASE origin WHEN 'cram' THEN 'cram' WHEN 'url' THEN CASE WHEN ends_with(location, '.gz') THEN 'gzip' ELSE 'bzip2' END ELSE 'plain' END AS opener FROM ({_LISTS})")
def s14_openers(spark, sf):
    d = _samples(spark, sf)
    return d.select("sample", IO.opener(F.col("location")).alias("opener"))


@query("SELECT 'R' || doc_id % 50 AS run, doc_id || '.' || (doc_id % 3) AS id FROM v_dna WHERE seq <> ''", "v_dna")
def s15_runs(spark, sf):
    """Files of both mates, of the first, of the second alone, and unpaired ones become one run each."""
    d = v_dna(spark, sf).where("seq <> ''").select(F.concat_ws(".", F.col("doc_id").cast("string"), (F.col("doc_id") % 3).cast("string")).alias("id"), (F.col("doc_id") % 3).alias("mate"), (F.col("doc_id") % 50).cast("string").alias("k"))
    name = F.concat(F.lit("fastq/R"), "k", F.when(F.col("mate") > 0, F.concat(F.lit("_"), F.col("mate").cast("string"))).otherwise(""), F.lit(".fastq.gz"))
    return IO.run_reads(d.select("id", name.alias("file"))).select("run", "id")


@query(f"SELECT read, line, tag, supp FROM ({_CUT}) WHERE chrom = 'chr7' AND flag & 4 = 0 AND \"start\" < 500 AND b[len(b)][2] > 300", "v_align")
def s19_region_reads(spark, sf):
    d = v_align(spark, sf).withColumnsRenamed({"tag": "t"}).withColumn("tag", F.col("chrom"))
    return IO.region_reads(d, "chr7", 300, 500).select("read", "line", F.col("t").alias("tag"), "supp")


def _bam(spark, sf) -> str:
    """The alignments as BAM files with their indexes; a read's name holds what the format has no field for."""
    path = shared_folder(spark, "bam")
    none = {"seq": "string", "qual": "string", "second": "int", "others": "string"}
    name = F.concat_ws(":", "read", "line", "tag", "supp").alias("read")
    rows = v_align(spark, sf).select(name, "flag", F.col("chrom").alias("tag"), "start", "cigar", "score", *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    B.write_bam(rows, spark.createDataFrame([(f"chr{i}", 1 << 20) for i in range(25)], "chrom string, size long"), path, 1 << 20)
    return path


_NAME = "concat_ws(':', read, line, tag, supp)"


@query(f'SELECT {_NAME} AS read, flag, chrom AS tag, CAST("start" AS BIGINT) AS "start", cigar, score FROM v_align', "v_align")
def s6_bam(spark, sf):
    """Every record of a folder of BAM files, each read in splits."""
    return B.bam(spark, _bam(spark, sf), 1 << 18).select("read", "flag", "tag", long("start"), "cigar", "score")


@query(f"SELECT {_NAME} AS name FROM (SELECT * FROM ({_CUT}) WHERE chrom = 'chr7' AND flag & 4 = 0 AND \"start\" < 500 AND b[len(b)][2] > 300)", "v_align")
def s19_bam_region(spark, sf):
    """A region through the binning index."""
    return B.bam_region(spark, _bam(spark, sf), "chr7", 300, 500).select(F.col("read").alias("name"))


@query(
    """WITH r AS (SELECT doc_id // 2 AS id, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 1 + doc_id % 2 END AS mate, CASE WHEN doc_id % 3 = 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq FROM v_dna WHERE seq <> ''),
b AS (SELECT *, sum(CASE WHEN mate > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY id) = 2 AS pair FROM r)
SELECT 'd' || id AS id, CASE WHEN pair AND mate > 0 THEN CAST(mate AS VARCHAR) ELSE 'single' END AS file, seq FROM b""",
    "v_dna",
)
def s16_alignment_pairs(spark, sf):
    """Alignments back to reads: mates and singles apart, as they were sequenced, each once though secondary records repeat them."""
    d = v_dna(spark, sf).where("seq <> ''")
    mate = F.when(F.col("doc_id") % 5 == 0, 0).when(F.col("doc_id") % 2 == 0, 0x41).otherwise(0x81)
    flag = mate + F.when(F.col("doc_id") % 3 == 0, 0x10).otherwise(0)
    rows = d.select(F.concat(F.lit("d"), F.floor(F.col("doc_id") / 2).cast("string")).alias("read"), flag.alias("flag"), F.concat(F.lit("chr"), (F.col("doc_id") % 9).cast("string")).alias("tag"), F.lit(1).alias("start"), "seq", F.lit("*").alias("qual"))
    again = rows.withColumn("flag", F.col("flag") + 0x100).withColumn("seq", F.lit("ACGT"))
    first, second, single = B.paired(B.read_pairs(rows.unionByName(again)))
    named = lambda d, file: d.select("id", F.lit(file).alias("file"), "seq")
    return named(first, "1").unionByName(named(second, "2")).unionByName(named(single, "single"))
