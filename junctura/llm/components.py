"""Connected components of an edge table by alternating large and small stars; every step is a join and an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch

_SALTS = 16


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Label each node of ``edges`` (u, v) with its component's smallest node: rows (node, component).

    Nulls and loops are ignored; repeated edges are harmless.
    """
    hi, lo = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = scratch.write(edges.where("u <> v").select(hi, lo).distinct(), f"{name}-0")
    mark, step = _mark(now), 0
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # only nodes with a larger neighbour are asked for; one of very many neighbours is dealt over salts
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x")).where("x > u").select("u", F.least("u", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
        large = both.where("v > u").withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(_SALTS)).cast("int")).join(least, ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.write(large, f"{name}-large")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        step += 1
        after = scratch.write(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}", f"{name}-large")
        seen = _mark(after)
        now = after
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
