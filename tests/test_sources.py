"""Readers on small files."""

import pytest
from pyspark.sql import functions as F

from junctura.operators import annotation as A
from junctura.sources import text as IO


def put(path, text):
    path.write_text(text)
    return str(path)


def test_fasta(spark, tmp_path):
    p = put(tmp_path / "g.fa", ">chr1 some words\nACgt\nAC\n>tx|more\nTT\n>empty\n")
    assert {(r.id, r.seq) for r in IO.fasta(spark, p).collect()} == {("chr1", "ACGTAC"), ("tx|more", "TT"), ("empty", "")}
    assert {r.id for r in IO.transcripts(spark, p).collect()} == {"chr1", "tx", "empty"}
    assert IO.chrom_sizes(IO.fasta(spark, p)).where("chrom = 'chr1'").first().size == 6


def test_fastq(spark, tmp_path):
    p = put(tmp_path / "r.fq", "@a x\nACGT\n+\nIIII\n@b\nAC\n+\n@II\n")
    got = IO.fastq(spark, p)
    assert {(r.id, r.seq, r.qual) for r in got.collect()} == {("a", "ACGT", "IIII"), ("b", "AC", "@II")}
    assert [r.id for r in IO.valid_reads(got).collect()] == ["a"]


def test_fasta_sign_in_header(spark, tmp_path):
    p = put(tmp_path / "g.fa", ">c1 a>b desc\nAC\nGT\n>c2 >x\r\nTT\r\n")
    assert {(r.id, r.seq) for r in IO.fasta(spark, p).collect()} == {("c1", "ACGT"), ("c2", "TT")}


def test_fastq_over_many_splits(spark, tmp_path):
    text = "".join(f"@r{i} x\n{'ACGT' * (i % 7 + 1)}\n+\n{'@+II' * (i % 7 + 1)}\n" for i in range(500))
    put(tmp_path / "a_1.fastq", text)
    put(tmp_path / "b.fastq", text.replace("@r", "@s") + "\n\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        d = IO.fastq(spark, str(tmp_path))
        assert d.count() == 1000
        got = {(r.id, r.seq, r.qual, r.run) for r in IO.run_reads(d).collect()}
        assert got == {(f"{x}{i}", "ACGT" * (i % 7 + 1), "@+II" * (i % 7 + 1), run) for x, run in (("r", "a"), ("s", "b")) for i in range(500)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fastq_out_of_step_and_cut_off(spark, tmp_path):
    p = put(tmp_path / "x.fq", "@a\nAC\nII\n@b\nAC\n+\nII\n")
    with pytest.raises(Exception, match="no FASTQ record at line 1"):
        IO.fastq(spark, p).collect()
    p = put(tmp_path / "y.fq", "@a\nAC\n+\nII\n@b\nAC\n")
    got = IO.fastq(spark, p)
    assert got.count() == 2 and [r.id for r in IO.valid_reads(got).collect()] == ["a"]


def test_fastq_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("a", "ACGT", "IIII"), ("b", "G", "@")], "id string, seq string, qual string")
    IO.write_fastq(d, str(tmp_path / "f"))
    assert {tuple(r) for r in IO.fastq(spark, str(tmp_path / "f")).select("id", "seq", "qual").collect()} == {tuple(r) for r in d.collect()}


def test_region_and_conservation(spark):
    d = spark.createDataFrame([("a", 0, "c", 10, "5M10N5M"), ("b", 0, "c", 5, "5M"), ("d", 4, "c", 12, "5M"), ("e", 0, "x", 12, "5M"), ("f", 0, "c", 30, "3M")], "read string, flag int, tag string, start int, cigar string")
    assert sorted(r.read for r in IO.region_reads(d, "c", 10, 30).collect()) == ["a"]
    m = spark.createDataFrame([("m", "c", 10, 20), ("n", "c", 500, 510)], "me string, chrom string, start int, end int")
    v = spark.createDataFrame([("c", 8, 10, 3.0)], "chrom string, start int, end int, value double")
    assert sorted(tuple(r) for r in IO.conservation(m, v, ["me"]).collect()) == [("m", 3.0), ("n", 0.0)]
    assert sorted(tuple(r) for r in IO.conservation(m, None, ["me"]).collect()) == [("m", 0.0), ("n", 0.0)]


def test_written_gtf(spark, tmp_path):
    rows = spark.createDataFrame([("c", "s", "exon", 4, 9, "-", 'gene_id "g"; transcript_id "t";')], "chrom string, source string, feature string, start int, end int, strand string, attributes string")
    IO.write_gtf(rows, str(tmp_path / "g"))
    assert [(r.start, r.end, r.gene, r.tx) for r in IO.gtf(spark, str(tmp_path / "g")).collect()] == [(4, 9, "g", "t")]


def test_all_sample_lists(spark, tmp_path):
    tsv = lambda name, column, rows: put(tmp_path / name, f"{column}\tsample\n" + "".join(f"{a}\t{b}\n" for a, b in rows))
    s = IO.samples(spark, None, tsv("l", "path", [("/a.fastq", "S1"), ("/a.fastq", "S1")]), None, tsv("c", "path", [("/b.cram", "S2")]))
    assert {(r.sample, r.origin, r.location) for r in s.collect()} == {("S1", "local", "/a.fastq"), ("S2", "cram", "/b.cram")}


def test_bed_gtf_sam(spark, tmp_path):
    bed = IO.bed12(spark, put(tmp_path / "a.bed", "c\t10\t60\tt1\t0\t+\t10\t60\t0\t2\t10,20,\t0,30,\nshort\trow\n"))
    e = sorted((r.tx, r.start, r.end) for r in A.bed12_exons(bed).collect())
    assert e == [("t1", 10, 20), ("t1", 40, 60)]
    gtf = IO.gtf(spark, put(tmp_path / "a.gtf", '#head\nc\ts\tgene\t1\t9\t.\t-\t.\tgene_id "g";\nc\ts\texon\t1\t9\t.\t-\t.\tgene_id "g"; transcript_id "t.1";\n'))
    assert {(r.feature, r.start, r.end, r.gene, r.tx) for r in gtf.collect()} == {("gene", 0, 9, "g", None), ("exon", 0, 9, "g", "t.1")}
    assert A.gtf_exons(gtf).count() == 1
    sam = IO.sam(spark, put(tmp_path / "a.sam", "@SQ\tx\nr\t16\ttag\t5\t9\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\tMD:Z:4\tAS:i:7\tXS:i:7\tXA:Z:t2,+3,4M,0;\nbad\n"))
    assert tuple(sam.select("read", "flag", "start", "score", "second", "others").first()) == ("r", 16, 4, 7, 7, "t2,+3,4M,0;")


def test_tables(spark, tmp_path):
    m = IO.weight_matrix(spark, put(tmp_path / "m", "A\tC\tG\tT\n0.1\t0.2\t0.3\t0.4\n"))
    assert m == [{"A": 0.1, "C": 0.2, "G": 0.3, "T": 0.4}]
    s = IO.samples(spark, put(tmp_path / "acc", "S1\nS1\n\n"), None, put(tmp_path / "url", "url\tsample\nhttp://x/a.fq.gz\tS2\n"))
    assert {(r.sample, r.origin) for r in s.collect()} == {("S1", "accession"), ("S2", "url")}
    assert s.select(IO.opener(F.col("location")).alias("o")).distinct().count() == 2
    assert IO.comparisons(spark, {"x": {"A": "a, b", "B": "c"}}).count() == 3
    IO.write_report(s, str(tmp_path / "out"), "origin")
    assert IO.table(spark, str(tmp_path / "out/origin=url")).first().sample == "S2"
    IO.write_fasta(spark.createDataFrame([("a", "AC")], "id string, seq string"), str(tmp_path / "fa"))
    assert IO.fasta(spark, str(tmp_path / "fa")).first().seq == "AC"


def test_comparison_file(spark, tmp_path):
    text = "---\n# all of them\nfirst one:\n  A : s1,s2, s3  # three\n  B : \"s4\"\n\n'x y':\n  A: [a, 'b']\n  B:\n    - c\n    - d#e\n"
    got = IO.comparison_file(spark, put(tmp_path / "c.yaml", text)).collect()
    assert sorted(map(tuple, got)) == sorted([("first one", "A", "s1"), ("first one", "A", "s2"), ("first one", "A", "s3"), ("first one", "B", "s4"), ("x y", "A", "a"), ("x y", "A", "b"), ("x y", "B", "c"), ("x y", "B", "d#e")])
    with pytest.raises(Exception, match="not a line"):
        IO.comparison_file(spark, put(tmp_path / "d.yaml", "a:\n  C: x\n")).collect()
