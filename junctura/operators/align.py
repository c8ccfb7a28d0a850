"""A native stand-in for short-read alignment to tags: ungapped matches with few mismatches.  Not equivalent to any aligner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mismatches(a, b):
    """Number of places at which two equally long sequences differ."""
    return F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda d: d))


def ungapped_matches(reads: DataFrame, tags: DataFrame, most: int = 2, seed: int = 12) -> DataFrame:
    """Alignments (read, tag, start, cigar, mismatches) of ``reads`` (id, seq) to ``tags`` (id, seq) with at most ``most`` mismatches.

    A read is cut into ``most + 1`` parts, of which one must match exactly; its first ``seed`` bases, or all of a shorter part, are joined to the
    tags' words of that length.  Reads of at most ``most`` bases match anywhere and are left out.  Repeated reads are aligned once.
    """
    n = most + 1
    r = reads.select(F.col("id").alias("read"), F.col("seq").alias("r_seq")).where(F.length("r_seq") >= n)
    part = F.floor(F.length("r_seq") / n)
    seeds = r.select("r_seq").distinct().withColumn("at", F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i * part).cast("int"))))
    seeds = seeds.withColumn("size", F.least(F.lit(seed), part).cast("int")).withColumn("word", F.substr("r_seq", F.col("at") + 1, F.col("size")))
    sizes = [x[0] for x in seeds.select("size").distinct().collect()] or [seed]  # at most ``seed`` numbers
    words = tags.select(F.col("id").alias("tag"), "seq", F.explode(F.array(*map(F.lit, sizes))).alias("size")).where(F.length("seq") >= F.col("size"))
    words = words.withColumn("w_at", F.explode(F.sequence(F.lit(0), F.length("seq") - F.col("size")))).withColumn("word", F.substr("seq", F.col("w_at") + 1, F.col("size"))).drop("size")
    hit = seeds.drop("size").join(words, "word").withColumn("start", F.col("w_at") - F.col("at")).where("start >= 0 and start + length(r_seq) <= length(seq)")
    hit = hit.select("r_seq", "tag", "start", mismatches(F.col("r_seq"), F.substr("seq", F.col("start") + 1, F.length("r_seq"))).alias("mismatches")).where(F.col("mismatches") <= most).distinct()
    return r.join(hit, "r_seq").select("read", "tag", "start", F.concat(F.length("r_seq").cast("string"), F.lit("M")).alias("cigar"), "mismatches", F.col("r_seq").alias("seq"))


def inserted_matches(reads: DataFrame, tags: DataFrame, me_len: int = 30, anchor: int = 12) -> DataFrame:
    """Reads (id, seq) that match a junction tag (id, seq, up) on both sides of its junction with an insertion between: (read, tag, start, cigar, seq).

    The read's first and last ``anchor`` bases are joined to the tags' words; both sides must match without mismatches and the insertion be at most ``me_len``.
    """
    r = reads.select(F.col("id").alias("read"), F.col("seq").alias("r_seq")).where(F.length("r_seq") >= 2 * anchor)
    r = r.withColumn("word", F.substring("r_seq", 1, anchor))
    t = tags.select(F.col("id").alias("tag"), "seq", "up")
    words = t.withColumn("start", F.explode(F.sequence(F.lit(0), F.greatest(F.col("up") - anchor, F.lit(0)).cast("int")))).withColumn("word", F.substr("seq", F.col("start") + 1, F.lit(anchor)))
    hit = r.join(words, "word").withColumn("left", F.col("up") - F.col("start"))
    # the part behind the insertion is as long as the read has left once it is placed at the tag's other side
    hit = hit.withColumn("ins", F.explode(F.sequence(F.lit(1), F.lit(me_len)))).withColumn("right", F.length("r_seq") - F.col("left") - F.col("ins"))
    hit = hit.where((F.col("right") >= anchor) & (F.col("right") <= F.length("seq") - F.col("up")))
    same = (F.substr("r_seq", F.lit(1), F.col("left").cast("int")) == F.substr("seq", (F.col("start") + 1).cast("int"), F.col("left").cast("int"))) & (F.right("r_seq", F.col("right").cast("int")) == F.substr("seq", (F.col("up") + 1).cast("int"), F.col("right").cast("int")))
    cigar = F.concat(F.col("left").cast("string"), F.lit("M"), F.col("ins").cast("string"), F.lit("I"), F.col("right").cast("string"), F.lit("M"))
    return hit.where(same).select("read", "tag", "start", cigar.alias("cigar"), F.col("r_seq").alias("seq"), "up").distinct()
