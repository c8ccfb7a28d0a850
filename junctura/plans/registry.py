"""Registered queries with their SQL, and the views they share.

The driver's tables hold no genomics, so each operator is applied to a view that both engines derive alike: documents as sequences, line items as
exons and alignments, events as read counts, parts as splice-graph nodes, customers as cells.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequence as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    """Register a function under its name, with the SQL of its result over ``views``."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = with_views(sql, *views)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_AZ, _NT = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"

VIEWS = {
    "v_dna": f"SELECT doc_id, translate(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '{_AZ}', '{_NT}') AS seq FROM documents",
    "v_exon": """SELECT tx, block, chrom, strand, CAST(base + run - len AS INTEGER) AS "start", CAST(base + run AS INTEGER) AS "end", len FROM (
  SELECT *, sum(len + gap) OVER (PARTITION BY tx ORDER BY block ROWS UNBOUNDED PRECEDING) - gap AS run FROM (
    SELECT l_orderkey AS tx, l_linenumber AS block, 'chr' || CAST(l_orderkey % (SELECT count(*) FROM documents) AS VARCHAR) AS chrom, CASE WHEN l_orderkey // 16 % 2 = 0 THEN '+' ELSE '-' END AS strand,
      CAST(max(l_quantity) AS BIGINT) AS len, 60 + max(l_partkey) % 97 AS gap, (l_orderkey // 25) % 40 * 50 AS base FROM lineitem GROUP BY l_orderkey, l_linenumber))""",
    "v_intron": """SELECT tx, block, chrom, strand, "end" AS "start", nxt AS "end" FROM (SELECT *, lead("start") OVER (PARTITION BY tx ORDER BY "start", block) AS nxt FROM v_exon) WHERE nxt IS NOT NULL""",
    "v_cov": """SELECT CAST(user_id AS BIGINT) AS sample, regexp_extract(props, '"k": *([0-9]+)', 1) AS me, count(*) FILTER (WHERE event_type = 'purchase') AS inc, count(*) FILTER (WHERE event_type <> 'purchase') AS skip FROM events GROUP BY 1, 2""",
    "v_node": """SELECT p_brand AS gene, CAST(p_partkey AS BIGINT) AS node, CASE p_partkey % 5 WHEN 0 THEN 'AA' WHEN 1 THEN 'AD' WHEN 2 THEN 'CE' WHEN 3 THEN 'TE' ELSE 'TS' END AS type,
  'chr' || CAST(p_partkey % 7 AS VARCHAR) AS chrom, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey * 20 AS "start", p_partkey * 20 + p_size AS "end", (p_retailprice - floor(p_retailprice / 100) * 100) / 100 AS psi FROM part""",
    "v_align": """SELECT CAST(l_orderkey AS BIGINT) AS read, CAST(l_partkey AS BIGINT) AS tag, CAST(l_linenumber AS INTEGER) AS line, CAST(l_suppkey AS BIGINT) AS supp, CAST(l_quantity AS INTEGER) AS score,
  CASE WHEN l_linenumber % 2 = 0 THEN 16 ELSE 0 END + CASE WHEN l_partkey % 3 = 0 THEN 64 WHEN l_partkey % 3 = 1 THEN 128 ELSE 0 END AS flag, 'chr' || CAST(l_orderkey % 25 AS VARCHAR) AS chrom, CAST(l_partkey % 900 AS INTEGER) AS "start",
  CASE l_suppkey % 5 WHEN 0 THEN q || 'M' || l || 'I' || p || 'M' WHEN 1 THEN q || 'M' || p || 'N' || p || 'M' WHEN 2 THEN q || 'M' || l || 'D' || p || 'M' || p || 'N' || l || 'M' || p || 'N' || q || 'M' WHEN 3 THEN l || 'S' || q || 'M' ELSE q || 'M' END AS cigar
FROM (SELECT *, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, CAST(l_linenumber AS VARCHAR) AS l, CAST(l_partkey % 50 + 10 AS VARCHAR) AS p FROM lineitem)""",
    "v_cell": "SELECT c_mktsegment AS cluster, CAST(c_custkey AS BIGINT) AS file FROM customer",
}
_NEEDS = {"v_intron": ("v_exon",)}


def with_views(sql: str, *views: str) -> str:
    names = list(dict.fromkeys(x for v in views for x in (*_NEEDS.get(v, ()), v)))
    if not names:
        return sql
    head = ", ".join(f"{v} AS MATERIALIZED ({VIEWS[v]})" for v in names)
    body = sql.strip()
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"


def v_dna(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.translate(F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "")), _AZ, _NT)
    # a generator keeps the sequence's derivation out of the lambdas of what is built on it
    return table(spark, sf_dir, "documents").select(F.inline(F.array(F.struct("doc_id", seq.alias("seq")))))


#: Rows of a task that groups and sorts them by transcript: some 900 bytes each are held at once.
TASK_ROWS = 1 << 18


def parts_of(rows: int, cores: int) -> int:
    """Parts of at most about ``TASK_ROWS`` rows; one for each core as soon as there are enough."""
    return max(1, -(-rows // TASK_ROWS), min(cores, -(-rows // (TASK_ROWS >> 3))))


def exon_parts(spark: SparkSession, sf_dir: str, times: int = 2) -> int:
    """Parts for what is made of the exons, ``times`` rows of each at most: by default one for each of its borders."""
    return parts_of(times * table(spark, sf_dir, "lineitem").count(), spark.sparkContext.defaultParallelism)


def v_exon(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt by transcript at once: the grouping and every window by transcript then need no other exchange; into so many parts that a task's rows stay few
    items = table(spark, sf_dir, "lineitem")
    d = items.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey").repartition(exon_parts(spark, sf_dir, 1), "l_orderkey")
    d = d.groupBy(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("block")).agg(F.max("l_quantity").cast("long").alias("len"), (60 + F.max("l_partkey") % 97).alias("gap"))
    run = F.sum(F.col("len") + F.col("gap")).over(Window.partitionBy("tx").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("gap")
    base = F.floor(F.col("tx") / 25) % 40 * 50
    d = d.withColumn("stop", base + run)
    # as many chromosomes as documents, whose sequences they have
    chroms = max(1, table(spark, sf_dir, "documents").count())
    chrom, strand = F.concat(F.lit("chr"), (F.col("tx") % chroms).cast("string")), F.when(F.floor(F.col("tx") / 16) % 2 == 0, "+").otherwise("-")
    return d.select("tx", "block", chrom.alias("chrom"), strand.alias("strand"), (F.col("stop") - F.col("len")).cast("int").alias("start"), F.col("stop").cast("int").alias("end"), "len")


def v_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").select(F.col("user_id").cast("long").alias("sample"), F.regexp_extract("props", '"k": *([0-9]+)', 1).alias("me"), (F.col("event_type") == "purchase").alias("in_me"))
    return d.groupBy("sample", "me").agg(F.count_if("in_me").alias("inc"), F.count_if(~F.col("in_me")).alias("skip"))


def v_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    kind = F.when(p % 5 == 0, "AA").when(p % 5 == 1, "AD").when(p % 5 == 2, "CE").when(p % 5 == 3, "TE").otherwise("TS")
    psi = (F.col("p_retailprice") - F.floor(F.col("p_retailprice") / 100) * 100) / 100
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("gene"), p.cast("long").alias("node"), kind.alias("type"), F.concat(F.lit("chr"), (p % 7).cast("string")).alias("chrom"), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"),
        (p * 20).alias("start"), (p * 20 + F.col("p_size")).alias("end"), psi.alias("psi"),
    )


def v_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n, p = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string"), (F.col("l_partkey") % 50 + 10).cast("string")
    of = F.col("l_suppkey") % 5
    M, I, N, D, X = (F.lit(c) for c in "MINDS")  # noqa: E741
    cigar = F.when(of == 0, F.concat(q, M, n, I, p, M)).when(of == 1, F.concat(q, M, p, N, p, M)).when(of == 2, F.concat(q, M, n, D, p, M, p, N, n, M, p, N, q, M)).when(of == 3, F.concat(n, X, q, M)).otherwise(F.concat(q, M))
    part = F.col("l_partkey") % 3
    flag = F.when(F.col("l_linenumber") % 2 == 0, 16).otherwise(0) + F.when(part == 0, 64).when(part == 1, 128).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("read"), F.col("l_partkey").cast("long").alias("tag"), F.col("l_linenumber").cast("int").alias("line"), F.col("l_suppkey").cast("long").alias("supp"), F.col("l_quantity").cast("int").alias("score"),
        flag.alias("flag"), F.concat(F.lit("chr"), (F.col("l_orderkey") % 25).cast("string")).alias("chrom"), (F.col("l_partkey") % 900).cast("int").alias("start"), cigar.alias("cigar"),
    )


def v_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("cluster"), F.col("c_custkey").cast("long").alias("file"))


__all__ = ["QUERIES", "S", "SQL", "VIEWS", "exon_parts", "query", "table", "v_align", "v_cell", "v_cov", "v_dna", "v_exon", "v_node", "with_views"]
