"""Readers of FASTA, FASTQ, BED12, GTF, SAM, weight matrices, bedGraph and tables; writers of the reports.

Rows of the wrong arity are dropped, as the formats' users expect; positions become 0-based and half-open on reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..operators.genome import WIDTH
from ..operators.intervals import mean_value
from .gz import gz_lines

BED12 = "chrom start end name score strand thick_start thick_end rgb block_count block_sizes block_starts".split()
SAM = "read flag tag pos mapq cigar rnext pnext tlen seq qual".split()


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, seq), upper case; the id ends at the first blank.

    A record begins at a line with ``>`` in front; the sign may also stand inside a header.  Records are split by Spark's reader, so a file's records are read in parallel.
    """
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).where(F.trim("value") != "")
    head = F.substring_index("value", "\n", 1)
    body = F.substring("value", F.length(head) + 2, F.length("value"))
    return rows.select(F.regexp_extract(head, r"^(\S+)", 1).alias("id"), F.upper(F.regexp_replace(body, r"\s+", "")).alias("seq"))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """FASTA whose ids are cut at the first bar."""
    return fasta(spark, path).withColumn("id", F.substring_index("id", "|", 1))


def fasta_tiles(spark: SparkSession, path: str, width: int = WIDTH) -> DataFrame:
    """Tiles (chrom, tile, seq) of :mod:`junctura.operators.genome` straight from FASTA lines, upper case: no chromosome is ever one row.

    Lines are numbered within their split of the file; how many bases of a record stand in front of a split is summed over the splits before it.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"), "value")
    lines = lines.withColumn("head", F.when(F.col("value").startswith(">"), F.regexp_extract("value", r"^>(\S*)", 1)))
    lines = lines.withColumn("text", F.when(F.col("head").isNull(), F.upper(F.regexp_replace("value", r"\s+", ""))).otherwise("")).withColumn("n", F.length("text").cast("long"))
    upto = Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    d = lines.withColumn("done", F.sum("n").over(upto)).withColumn("own", F.last("head", True).over(upto)).withColumn("from", F.last(F.when(F.col("head").isNotNull(), F.col("done")), True).over(upto))
    tail = F.col("all") - F.coalesce("last_from", F.lit(0))
    splits = d.groupBy("file", "split").agg(F.max("done").alias("all"), F.max_by("head", F.when(F.col("head").isNotNull(), F.col("row"))).alias("last"), F.max("from").alias("last_from")).withColumn("tail", tail)
    by = Window.partitionBy("file").orderBy("split")
    splits = splits.withColumn("record", F.count("last").over(by))
    splits = splits.withColumn("after", F.sum("tail").over(Window.partitionBy("file", "record").orderBy("split").rowsBetween(Window.unboundedPreceding, 0)))
    splits = splits.select("file", "split", F.last("last", True).over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("held"), F.coalesce(F.lag("after").over(by), F.lit(0)).alias("before"))
    d = d.join(splits, ["file", "split"]).withColumn("at", F.col("done") - F.col("n") - F.coalesce("from", -F.col("before")))
    d = d.select(F.coalesce("own", "held").alias("chrom"), "at", "text", "n").where("chrom is not null")
    # a header stands for its record's first tile, if that has no bases
    every = F.sequence(F.floor(F.col("at") / width).cast("int"), F.floor((F.col("at") + F.greatest(F.col("n"), F.lit(1)) - 1) / width).cast("int"))
    piece = lambda t: F.substr("text", F.greatest(t * width - F.col("at"), F.lit(0)).cast("int") + 1, (F.least(F.col("at") + F.col("n"), (t + 1) * width) - F.greatest(F.col("at"), t * width)).cast("int"))
    d = d.where("n > 0 or at = 0").select("chrom", F.inline(F.transform(every, lambda t: F.struct(t.alias("tile"), F.greatest(F.col("at"), t * width).alias("at"), piece(t).alias("piece")))))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "")
    return d.groupBy("chrom", "tile").agg(whole.alias("seq"))


def chrom_sizes(genome: DataFrame) -> DataFrame:
    """(chrom, size) of whole sequences (id, seq) or of tiles."""
    if "tile" in genome.columns:
        return genome.groupBy("chrom").agg(F.sum(F.length("seq")).cast("long").alias("size"))
    return genome.select(F.col("id").alias("chrom"), F.length("seq").cast("long").alias("size"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): text lines with their 0-based number in their file, whatever the number of splits it is read in.

    A first pass counts the lines of each split; a line's number is that of the lines in splits in front of its own, and its place in the split.
    """
    at = {"file": F.col("_metadata.file_path"), "split": F.col("_metadata.file_block_start"), "row": F.monotonically_increasing_id()}
    return _numbered(spark.read.text(path).select("value", *(c.alias(n) for n, c in at.items())))


def _numbered(lines: DataFrame) -> DataFrame:
    """(file, line, value) of lines (file, split, row, value), whose ``row`` rises by one within each split of a file."""
    splits = lines.groupBy("file", "split").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.join(splits.select("file", "split", "first", before.alias("before")), ["file", "split"]).select("file", (F.col("before") + F.col("row") - F.col("first")).alias("line"), "value")


def fastq(spark: SparkSession, path: str, members: bool = False, split_bytes: int = 64 << 20) -> DataFrame:
    """(id, seq, qual, file): records of four lines each, of plain or compressed files of any number of splits.

    With ``members`` the files are gzip, and those of several members, blocked ones among them, are read by as many tasks as ``split_bytes`` gives.

    Blank lines at the end are skipped, a record cut off by the end of its file has null fields, and a file whose records do not begin with @ and + is refused.
    """
    lines = _numbered(gz_lines(spark, path, split_bytes)) if members else numbered_lines(spark, path)
    d = lines.select("file", F.floor(F.col("line") / 4).alias("record"), (F.col("line") % 4).alias("part"), "value")
    pick = lambda i: F.max(F.when(F.col("part") == i, F.col("value")))
    d = d.groupBy("file", "record").agg(pick(0).alias("h"), pick(1).alias("seq"), pick(2).alias("plus"), pick(3).alias("qual")).where(F.trim(F.concat_ws("", "h", "seq", "plus", "qual")) != "")
    wrong = ~F.col("h").startswith("@") | ~F.coalesce(F.col("plus").startswith("+"), F.lit(True))
    ident = F.when(wrong, F.raise_error(F.concat(F.lit("no FASTQ record at line "), (F.col("record") * 4 + 1).cast("string"), F.lit(" of "), "file"))).otherwise(F.regexp_extract("h", r"^@(\S*)", 1))
    return d.select(ident.alias("id"), "seq", "qual", "file")


def run_of(file: Column) -> Column:
    """The run that a read file belongs to: its name without folder, endings and mate number."""
    return F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"(_[12])?\.(fastq|fq)(\.(gz|bz2))?$", "")


def run_reads(reads: DataFrame) -> DataFrame:
    """Reads (id, seq, qual, file) with their ``run``: both mates' files are one run, a single file is the run whatever its mate number."""
    return reads.withColumn("run", run_of(F.col("file"))).drop("file")


def valid_reads(reads: DataFrame) -> DataFrame:
    """Reads whose sequence and qualities are equally long."""
    return reads.where(F.length("seq") == F.length("qual"))


def _fields(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.split("value", "\t").alias("f"))


def int_list(text: Column) -> Column:
    """Integers of a comma list, with or without a trailing comma."""
    return F.transform(F.split(F.rtrim(text, F.lit(",")), ","), lambda x: x.cast("int"))


def bed12(spark: SparkSession, path: str) -> DataFrame:
    rows = _fields(spark, path).where(F.size("f") == 12)
    d = rows.select(*(F.get("f", i).alias(c) for i, c in enumerate(BED12)))
    ints = {c: F.col(c).cast("int") for c in ("start", "end", "thick_start", "thick_end", "block_count")}
    return d.withColumns(ints | {c: int_list(F.col(c)) for c in ("block_sizes", "block_starts")})


def attribute(attributes: Column, key: str) -> Column:
    """A GTF attribute, null where it is absent."""
    return F.nullif(F.regexp_extract(attributes, rf'(?:^|;)\s*{key} "([^"]*)"', 1), F.lit(""))


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """Features with gene and transcript ids, 0-based."""
    rows = _fields(spark, path).where((F.size("f") == 9) & ~F.get("f", 0).startswith("#"))
    g = lambda i: F.get("f", i)
    return rows.select(g(0).alias("chrom"), g(1).alias("source"), g(2).alias("feature"), (g(3).cast("int") - 1).alias("start"), g(4).cast("int").alias("end"), g(6).alias("strand"), attribute(g(8), "gene_id").alias("gene"), attribute(g(8), "transcript_id").alias("tx"), g(8).alias("attributes"))


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments, 0-based, with AS, XS and XA of their optional fields; headers and short rows are skipped."""
    rows = _fields(spark, path).where(~F.get("f", 0).startswith("@") & (F.size("f") >= 11))
    d = rows.select("f", *(F.get("f", i).alias(c) for i, c in enumerate(SAM)))
    tag = lambda t: F.regexp_extract(F.array_join("f", "\t"), rf"\t{t}:[A-Za-z]:([^\t]*)", 1)
    return d.select("read", F.col("flag").cast("int"), "tag", (F.col("pos").cast("int") - 1).alias("start"), "cigar", "seq", "qual", F.nullif(tag("AS"), F.lit("")).cast("int").alias("score"), F.nullif(tag("XS"), F.lit("")).cast("int").alias("second"), F.nullif(tag("XA"), F.lit("")).alias("others"))


def region_reads(alignments: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """Mapped alignments (tag, start, cigar, flag) that cover a base of ``start:end`` (0-based) of a chromosome."""
    ops = C.parse(F.col("cigar"))
    stop = F.col("start") + F.greatest(C.length_of(ops, "MDN=X"), F.lit(1))
    return alignments.where((F.col("tag") == chrom) & (F.col("flag").bitwiseAND(4) == 0) & (F.col("start") < end) & (stop > start))


def conservation(regions: DataFrame, values: DataFrame | None, ident: list[str], flank: int = 2) -> DataFrame:
    """Mean of interval values over each region widened by ``flank``; 0 where nothing is known, and everywhere without ``values``."""
    if values is None:
        return regions.select(*ident).distinct().withColumn("mean", F.lit(0.0))
    return mean_value(regions, values, ident, flank).withColumn("mean", F.coalesce("mean", F.lit(0.0)))


def weight_matrix(spark: SparkSession, path: str) -> list[dict[str, float]]:
    """A position weight matrix: tens of rows of a headered table."""
    return [{k: float(v) for k, v in r.asDict().items()} for r in spark.read.csv(path, sep="\t", header=True).select("A", "C", "G", "T").collect()]


def bedgraph(spark: SparkSession, path: str) -> DataFrame:
    """Values of intervals, such as conservation: (chrom, start, end, value)."""
    return spark.read.schema("chrom string, start int, end int, value double").csv(path, sep="\t", comment="#", mode="DROPMALFORMED")


def table(spark: SparkSession, path: str) -> DataFrame:
    """A headered table, plain or gzipped, all columns text."""
    return spark.read.csv(path, sep="\t", header=True)


def samples(spark: SparkSession, accessions: str | None = None, local: str | None = None, urls: str | None = None, cram: str | None = None) -> DataFrame:
    """Distinct (sample, origin, location) of up to four lists."""
    out = spark.createDataFrame([], "sample string, origin string, location string")
    if accessions:
        out = out.unionByName(spark.read.text(accessions).where(F.trim("value") != "").select(F.trim("value").alias("sample"), F.lit("accession").alias("origin"), F.trim("value").alias("location")))
    for path, origin, column in ((local, "local", "path"), (urls, "url", "url"), (cram, "cram", "path")):
        if path:
            out = out.unionByName(table(spark, path).select("sample", F.lit(origin).alias("origin"), F.col(column).alias("location")))
    return out.distinct()


def opener(location: Column) -> Column:
    """How a read file is opened, by its ending."""
    return F.when(location.endswith(".gz"), "gzip").when(location.endswith(".bz2"), "bzip2").when(location.endswith(".cram"), "cram").otherwise("plain")


def merge_mates(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both mates' reads, ids with _1 and _2."""
    return first.withColumn("id", F.concat("id", F.lit("_1"))).unionByName(second.withColumn("id", F.concat("id", F.lit("_2"))))


def split_pairs(reads: DataFrame) -> DataFrame:
    """Collapsed pairs cut in the middle."""
    half = F.floor(F.length("seq") / 2).cast("int")
    side = lambda c, left: F.substr(F.col(c), F.lit(1), half) if left else F.substr(F.col(c), half + 1)
    both = F.array(*(F.struct(F.lit(i).alias("mate"), side("seq", i == 1).alias("seq"), side("qual", i == 1).alias("qual")) for i in (1, 2)))
    return reads.select("id", F.explode(both).alias("m")).select("id", "m.mate", "m.seq", "m.qual")


def comparisons(spark: SparkSession, spec: dict[str, dict[str, str]]) -> DataFrame:
    """(comparison, side, sample) of comparisons with comma lists A and B, as a configuration file gives them."""
    rows = [(c, side, s.strip()) for c, sides in spec.items() for side in ("A", "B") for s in sides[side].split(",") if s.strip()]
    return spark.createDataFrame(rows, "comparison string, side string, sample string")


def comparison_file(spark: SparkSession, path: str) -> DataFrame:
    """(comparison, side, sample) of a YAML file: a mapping of comparisons, each with A and B as comma lists, flow lists or block lists of samples.

    Comments and blank lines are skipped; any other line is refused.  A comparison's rows follow its head within the file, so the file goes through one window.
    """
    lines = numbered_lines(spark, path).withColumn("value", F.regexp_replace("value", r"(^|\s+)#.*$|\s+$|^---$", "")).where("value <> ''")
    bare = lambda c: F.regexp_replace(F.trim(c), r"^([\"'])(.*)\1$", "$2")
    head, side, item = r"^([^\s-].*?)\s*:$", r"^\s+[\"']?([AB])[\"']?\s*:\s*(.*)$", r"^\s*-\s+(.+)$"
    get = lambda pattern, i: F.when(F.col("value").rlike(pattern), F.regexp_extract("value", pattern, i))
    d = lines.withColumns({"head": get(head, 1), "own": get(side, 1), "items": F.coalesce(get(side, 2), get(item, 1))})
    wrong = F.col("head").isNull() & F.col("items").isNull()
    d = d.withColumn("items", F.when(wrong, F.raise_error(F.concat(F.lit("not a line of comparisons: "), "value")).cast("string")).otherwise(F.col("items")))
    upto = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    d = d.select(bare(F.last("head", True).over(upto)).alias("comparison"), F.last("own", True).over(upto).alias("side"), "items").where("items is not null")
    each = F.explode(F.split(F.regexp_replace("items", r"^\[|\]$", ""), ",")).alias("sample")
    return d.select("comparison", "side", each).select("comparison", "side", bare(F.col("sample")).alias("sample")).where("sample <> ''")


def write_report(df: DataFrame, path: str, by: str | None = None) -> None:
    """Gzipped tab-separated report, one folder for each value of ``by``."""
    out = df.write.mode("overwrite").option("sep", "\t").option("header", True).option("compression", "gzip").option("nullValue", "NA")
    (out.partitionBy(by) if by else out).csv(path)


def write_fasta(df: DataFrame, path: str) -> None:
    df.select(F.concat(F.lit(">"), "id", F.lit("\n"), "seq")).write.mode("overwrite").text(path)


def write_fastq(df: DataFrame, path: str) -> None:
    """Reads (id, seq, qual) as gzipped records of four lines."""
    df.select(F.concat(F.lit("@"), "id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")).write.mode("overwrite").option("compression", "gzip").text(path)


def write_gtf(df: DataFrame, path: str) -> None:
    """Rows of :func:`junctura.operators.isoforms.gtf_rows` as text."""
    df.select(F.concat_ws("\t", "chrom", "source", "feature", (F.col("start") + 1).cast("string"), F.col("end").cast("string"), F.lit("."), "strand", F.lit("."), "attributes")).write.mode("overwrite").text(path)
