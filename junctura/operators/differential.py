"""Differential inclusion: node tables, exon nodes, replicates, pools of single cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import beta_probability
from .intervals import carried

NODE = ["gene", "node", "coord", "strand", "type"]


def replace_psi(nodes: DataFrame, mes: DataFrame) -> DataFrame:
    """Node inclusion replaced by the microexon's of the same coordinate, unless that is null; the last of repeated coordinates counts (column ``row``)."""
    last = mes.groupBy("coord").agg(F.max_by("psi", "row").alias("me_psi"))
    return nodes.join(last, "coord", "left").withColumn("psi", F.coalesce("me_psi", "psi")).drop("me_psi")


def node_exons(exons: DataFrame) -> DataFrame:
    """(gene, node, exon) from comma lists of nodes; of several exons of a node the last one (column ``row``)."""
    d = exons.select("gene", "exon", "row", F.explode(F.split("nodes", ",")).alias("node"))
    return d.groupBy("gene", "node").agg(F.max_by("exon", "row").alias("exon"))


def exon_of_node(d: DataFrame) -> DataFrame:
    """Id of the exon a node stands for: rows (chrom, strand, n_start, n_end 1-based, type, x_start, x_end 1-based potential exon or null).

    Plain nodes are their own exon; alternative donors and acceptors take the potential exon's where it ends or begins with the node, by strand.
    """
    ident = lambda s, e: F.concat_ws("_", "chrom", "strand", (F.col(s) - 1).cast("string"), F.col(e).cast("string"))
    plus, ends, begins = F.col("strand") == "+", F.col("x_end") == F.col("n_end"), F.col("x_start") == F.col("n_start")
    takes = ((F.col("type") == "AD") & ((plus & ends) | (~plus & begins))) | ((F.col("type") == "AA") & ((~plus & ends) | (plus & begins)))
    return d.withColumn("exon_id", F.when(F.coalesce(takes, F.lit(False)), ident("x_start", "x_end")).otherwise(ident("n_start", "n_end")))


def replicate_stats(rows: DataFrame) -> DataFrame:
    """Means over replicates by node: inclusion means are null if any value is, probabilities drop nulls."""
    strict = lambda c: F.when(F.count(c) == F.count("*"), F.avg(c))
    return rows.groupBy(*NODE).agg(
        strict("psi_a").alias("psi_a_mean"), strict("psi_b").alias("psi_b_mean"), strict("delta").alias("delta_mean"), F.when(F.count("delta") == F.count("*"), F.stddev_samp("delta")).alias("delta_sd"),
        F.avg("probability").alias("p_mean"), F.stddev_samp("probability").alias("p_sd"), F.var_samp("probability").alias("p_var"), F.count("*").alias("number"),
    )


def significant(stats: DataFrame, cdf_t: float, min_delta: float, min_p: float, min_rep: int) -> DataFrame:
    """``cdf`` of the fitted Beta distribution at ``cdf_t`` and ``diff``: strict over ``min_rep``, never for transcript ends."""
    d = stats.withColumn("cdf", beta_probability(F.lit(cdf_t), F.col("p_mean"), F.col("p_var")))
    return d.withColumn("diff", F.coalesce((F.abs("delta_mean") >= min_delta) & (F.col("cdf") < 0.05) & (F.col("p_mean") >= min_p) & ~F.col("type").isin("TE", "TS") & (F.col("number") > min_rep), F.lit(False)))


def targets(diff: DataFrame) -> DataFrame:
    """The places to look at: distinct (gene, coord) of nodes that differ."""
    return diff.where("diff").select("gene", "coord").distinct()


def named_clusters(comparisons: DataFrame) -> DataFrame:
    """One row for each cluster that a comparison's side names."""
    return comparisons.withColumn("cluster", F.explode(F.split("clusters", ","))).withColumn("cluster", F.trim("cluster"))


def side_files(comparisons: DataFrame, cells: DataFrame) -> DataFrame:
    """The files of each comparison's sides as a comma list."""
    d = named_clusters(comparisons).join(cells, "cluster").groupBy("comparison", "side").agg(F.array_sort(F.collect_list("file")).alias("f"))
    return d.select("comparison", "side", F.array_join(F.transform("f", lambda x: x.cast("string")), ",").alias("files"))


def cluster_files(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_list("file")), ",").alias("files"), F.count("*").alias("n"))


def _placed(rows: DataFrame, group: list[str]) -> tuple[DataFrame, Column]:
    """Rows and their 0-based place in the order of (key, file) in their group; ranges of the hash ``key`` spread a group over tasks."""
    d = carried(rows.withColumn("at", F.conv(F.substring("key", 1, 3), 16, 10).cast("int")), group, "at", F.lit(1), F.sum, 1)
    return d, F.coalesce("carried", F.lit(0)) + F.row_number().over(Window.partitionBy(*group, "bin").orderBy("key", "file")) - 1


def pools(comparisons: DataFrame, cells: DataFrame, seed: int) -> DataFrame:
    """Cells of each comparison's sides dealt into pools in every repeat: (comparison, side, rep, pool, file), pools from 1.

    ``comparisons``: (comparison, side, clusters comma list, n_pools, repeats).  The order is a hash of seed, repeat and file, so it needs no generator state.
    """
    d = named_clusters(comparisons).withColumn("rep", F.explode(F.sequence(F.lit(1), "repeats"))).join(cells, "cluster")
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("rep").cast("string"), F.col("file").cast("string")))
    d, place = _placed(d.withColumn("key", key), ["comparison", "side", "rep"])
    return d.withColumn("pool", (F.pmod(place, F.col("n_pools")) + 1).cast("int")).select("comparison", "side", "rep", "pool", "file")


def missing_clusters(comparisons: DataFrame, cells: DataFrame) -> DataFrame:
    """Clusters that comparisons name and no cell has."""
    named = named_clusters(comparisons).select("comparison", "cluster")
    return named.join(cells.select("cluster"), "cluster", "left_anti").distinct()


def pseudo_bulk_count(n):
    """At least 3, else cells by 15 rounded half to even."""
    return F.greatest(F.lit(3), F.bround(n / 15).cast("int"))


def membership(cells: DataFrame, seed: int) -> DataFrame:
    """(cluster, bulk, files): each cluster's cells dealt into its pseudo-bulks."""
    sized = cells.join(cells.groupBy("cluster").agg(F.count("*").alias("n")), "cluster").withColumn("bulks", pseudo_bulk_count(F.col("n")))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("file").cast("string")))
    sized, place = _placed(sized.withColumn("key", key), ["cluster"])
    d = sized.withColumn("bulk", (F.pmod(place, F.col("bulks")) + 1).cast("int"))
    return d.groupBy("cluster", "bulk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("file")), lambda x: x.cast("string")), ",").alias("files"))


def merge_quant(parts: DataFrame) -> DataFrame:
    """Quantification tables of several files with the sample from each file's name, one header."""
    return parts.withColumn("sample", F.regexp_extract("file", r"([^/]*?)(?:\.[a-z]+)*$", 1)).drop("file")
