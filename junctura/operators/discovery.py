"""Discovery: split reads on junction tags to candidate microexons, competition with the genome, and the microexon table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cigar as C
from ..functions import sequence as S
from ..sources.shared import written
from .dealing import dealt
from .neighbours import neighbour_lists, neighbour_marks, packed_lists, parts_of_pairs

ANCHOR = 8


def alternative_hits(sam: DataFrame) -> DataFrame:
    """The primary hit and, where a second hit scores as well, the forward hits of XA: one row each."""
    listed = F.filter(F.split(F.coalesce("others", F.lit("")), ";"), lambda x: x.rlike(r",\+\d+,"))
    others = F.transform(listed, lambda x: F.struct(F.regexp_extract(x, r"^(.*),([+-])(\d+),([^,]*),\d+$", 1).alias("tag"), (F.regexp_extract(x, r"^(.*),([+-])(\d+),([^,]*),\d+$", 3).cast("int") - 1).alias("start"), F.regexp_extract(x, r"^(.*),([+-])(\d+),([^,]*),\d+$", 4).alias("cigar")))
    first = F.array(F.struct("tag", F.col("start").cast("int").alias("start"), "cigar"))
    hits = F.when(F.col("score") == F.col("second"), F.concat(first, others)).otherwise(first)
    rest = [c for c in sam.columns if c not in ("tag", "start", "cigar")]
    return sam.select(*rest, F.explode(hits).alias("h")).select(*rest, "h.tag", "h.start", "h.cigar")


def one_insertion(sam: DataFrame) -> DataFrame:
    """Alignments with exactly one insertion between two blocks, with its place and length."""
    d = sam.withColumn("ops", C.parse(F.col("cigar")))
    d = d.where((C.count_of(F.col("ops"), "I") == 1) & ~F.get("ops", 0)["op"].isin("I") & ~F.element_at("ops", -1)["op"].isin("I"))
    at = F.get(F.filter(C.query_blocks(F.col("ops")), lambda b: b["end"] > b["start"]), 0)["end"]
    return d.withColumns({"ins_at": at, "ins_len": C.length_of(F.col("ops"), "I")}).drop("ops")


def in_repeat_window(d: DataFrame) -> DataFrame:
    """The junction lies where the insertion can move to: ``ins_at - dru <= up <= ins_at + drd``."""
    return d.where("up between ins_at - dru and ins_at + drd")


def reanchor(found, up, ins_at, seq):
    """The inserted sequence shifted to the junction, or as found where that leaves the read."""
    moved = F.substr(seq, (up + 1).cast("int"), F.length(found))
    return F.coalesce(F.nullif(moved, F.lit("")), found)


def introns_per_read(hits: DataFrame, read: str = "read", intron: str = "intron") -> DataFrame:
    """Number of distinct introns that each read's hits name."""
    return hits.groupBy(read).agg(F.countDistinct(intron).alias("introns"))


def unique_intron(hits: DataFrame, read: str = "read", intron: str = "intron") -> DataFrame:
    """Reads whose hits name one intron."""
    one = hits.groupBy(read).agg(F.min(intron).alias("lo"), F.max(intron).alias("hi")).where("lo = hi").select(read)
    return hits.join(one, read, "left_semi")


def candidates(introns: DataFrame) -> DataFrame:
    """Places of AG + sequence + GT in each host intron (columns intron_seq, me_seq): the microexon's 0-based starts."""
    # the same pair is searched once, whatever the number of reads
    pairs = introns.select("intron_seq", "me_seq").distinct()
    found = pairs.select("*", F.explode(S.overlapping(F.col("intron_seq"), F.concat(F.lit("AG"), "me_seq", F.lit("GT")))).alias("at"))
    return introns.join(found, ["intron_seq", "me_seq"]).withColumn("at", F.col("at") + 2)


def read_filter(reads: DataFrame, me_len: int) -> DataFrame:
    """Reads anchored by 8 bases, with one insertion of at most ``me_len``, no deletion and no clipping."""
    ops = C.parse(F.col("cigar"))
    return reads.where((F.col("start") <= F.col("up") - ANCHOR) & (C.count_of(ops, "I") == 1) & (C.count_of(ops, "DS") == 0) & (C.length_of(ops, "I") <= me_len))


def best_alignment(alignments: DataFrame, read: str = "read") -> DataFrame:
    """The alignment of each read with the best score; the first wins ties (column ``row``)."""
    others = [c for c in alignments.columns if c not in (read, "score", "row")]
    top = alignments.groupBy(read).agg(F.max_by(F.struct("score", "row", *others), F.struct("score", -F.col("row"))).alias("t"))
    return top.select(read, "t.*")


def genome_competition(reads: DataFrame, genome: DataFrame) -> DataFrame:
    """Reads without a genome hit, with one on the same microexon, or with a better tag score (t_score, g_score, same_me)."""
    return reads.join(genome, "read", "left").where("g_score is null or same_me or t_score > g_score")


def same_exon(blocks, coords):
    """Is one of the genome alignment's blocks a candidate?  Compared exactly."""
    return F.arrays_overlap(blocks, coords)


def coverage(reads: DataFrame, key: list[str]) -> DataFrame:
    """Distinct read sequences for each key."""
    return reads.groupBy(*key).agg(F.countDistinct("seq").alias("coverage"))


def sharing(pairs: DataFrame, key: str, item: str) -> DataFrame:
    """Pairs of keys (k < other) that share an item, with the number of items."""
    d = pairs.select(F.col(key).alias("k"), F.col(item).alias("i")).distinct()
    return d.join(d.withColumnRenamed("k", "other"), "i").where("k < other").groupBy("k", "other").agg(F.count("*").alias("shared"))


def widest_items(lists: DataFrame, wide: int) -> DataFrame:
    """Lists (i, ks) of each item's keys without the items whose keys all have a common item too, one of ``wide`` keys or more: they bring no key a neighbour that the
    common one does not.

    An item is within a common one if it stands beside it as often as it stands anywhere, which is counted over the pairs of an item and a common one of each key, never over
    pairs of keys.  Of common items with the same keys the smallest stays.
    """
    common = lists.where(F.size("ks") >= wide)
    if common.isEmpty():
        return lists
    # what a list gives is taken before it is dealt out, else each key's row would hold the list
    pairs = lists.withColumn("degree", F.size("ks")).select("i", "degree", F.explode("ks").alias("k"))
    common = common.withColumn("wide", F.size("ks")).select(F.col("i").alias("other"), "wide", F.explode("ks").alias("k"))
    beside = pairs.join(common, "k").where("i <> other").groupBy("i", "degree", "other", "wide").agg(F.count("*").alias("n"))
    within = beside.where("n = degree and (wide > degree or other < i)").select("i").distinct()
    return lists.join(within, "i", "left_anti")


def _narrow(d: DataFrame, *cols: str) -> DataFrame:
    """``d`` with those of the columns as int that are long and whose values all fit: lists of them then take half the room."""
    longs = [c for c in cols if d.schema[c].dataType == T.LongType()]
    if not longs:
        return d
    most = d.agg(*(F.max(F.greatest(F.col(c), -1 - F.col(c))).alias(c) for c in longs)).first()
    return d.withColumns({c: F.col(c).cast("int") for c in longs if (most[c] or 0) < 1 << 31})


def _joined_sets(d: DataFrame, wide: int) -> DataFrame:
    """:func:`neighbour_sets` of pairs (k, i) by joins: lists of keys move once, to a key of each set of items.

    The least of four hashes of a key's neighbours are those of its items' keys, so they are known before the lists are joined; equal lists have equal ones, and only
    lists that share theirs with others are compared.  The items' lists and the sets are tables in the shared folder.
    """
    lists = widest_items(written(_narrow(d, "k", "i").groupBy("i").agg(F.collect_set("k").alias("ks")), "items"), wide)
    least = lambda j: F.array_min(F.transform("ks", lambda k: F.hash(k, F.lit(j))))
    marks = [f"m{j}" for j in range(4)]
    sets = lists.withColumns({m: least(j) for j, m in enumerate(marks)}).select("i", *marks, F.explode("ks").alias("k")).groupBy("k").agg(F.array_sort(F.collect_list("i")).alias("items"), *(F.min(m).alias(m) for m in marks))
    # keys with the same items have the same neighbours: each set of items is joined once, to whole lists of keys in place of pairs
    sets = sets.repartition(*marks).groupBy(*marks, "items").agg(F.min("k").alias("k")).withColumn("alone", F.count("*").over(Window.partitionBy(*marks)) == 1)
    sets = written(sets.select("k", "items", "alone"), "sets")

    def near(some: DataFrame) -> DataFrame:
        found = some.select("k", F.explode("items").alias("i")).join(lists, "i").groupBy("k").agg(F.collect_list("ks").alias("ks"))
        return found.select(F.array_sort(F.array_distinct(F.flatten("ks"))).alias("keys"))

    return near(sets.where("alone")).unionByName(near(sets.where("not alone")).distinct())


def neighbour_sets(pairs: DataFrame, key: str, item: str, wide: int = 1000) -> DataFrame:
    """For each key the keys that share an item with it, as a sorted list; equal lists once.

    Keys that are integers are dealt into parts by ranges, and an item's list moves packed, once to each part that holds a key of it: keys made together, as reads in file
    order are, find their neighbours in few parts, and no list is moved for each of its keys.  Other keys are joined, as uniting strings in a part takes longer.  Of the lists, which are made in their part and not moved, only those whose
    marks others share are compared.  Where an item has ``wide`` keys or more, items that lie within it are dropped first (:func:`widest_items`), and one key asks for
    each set of items.  The items' lists are a table in the shared folder.
    """
    d = pairs.select(F.col(key).alias("k"), F.col(item).alias("i")).where("k is not null and i is not null")
    of, cores = d.schema["k"].dataType, d.sparkSession.sparkContext.defaultParallelism
    if not isinstance(of, T.IntegralType):
        return _joined_sets(d, wide)
    lists = written(dealt(_narrow(d, "k", "i"), parts_of_pairs(d.count(), 0, cores), "i").groupBy("i").agg(F.array_sort(F.collect_set("k")).alias("ks")), "items")
    if lists.where(F.size("ks") >= wide).isEmpty():
        lists = lists.withColumn("own", F.col("ks"))
    else:
        lists = widest_items(lists, wide)
        sets = lists.select("i", F.explode("ks").alias("k")).groupBy("k").agg(F.array_sort(F.collect_list("i")).alias("items")).groupBy("items").agg(F.min("k").alias("k"))
        asking = sets.select("k", F.explode("items").alias("i")).groupBy("i").agg(F.collect_list("k").alias("own"))
        lists = written(lists.join(asking, "i"), "asking")
    size = lambda c: F.size(c).cast("long")
    n = lists.agg(F.sum(size("own")).alias("pairs"), F.sum(size("own") * size("ks")).alias("keys"), F.avg(F.size("ks")).alias("mean")).first()
    parts = parts_of_pairs(n["pairs"] or 0, n["keys"] or 0, cores)
    packed = packed_lists(lists, parts, n["mean"])
    marks = neighbour_marks(packed, lists.schema["ks"].dataType.elementType).repartition(parts, "mark")
    marks = marks.groupBy("mark").agg(F.collect_list(F.struct("part", "k")).alias("at"), (F.count("*") == 1).alias("alone"))
    near = lambda some: neighbour_lists(packed, some.select(F.inline("at")))
    return near(marks.where("alone")).unionByName(near(marks.where("not alone")).distinct()).select(F.col("keys").cast(T.ArrayType(of)))


def intersect_sets(sets):
    """Intersection of an array of arrays."""
    return F.array_sort(F.aggregate(F.slice(sets, F.lit(2), F.greatest(F.size(sets) - 1, F.lit(0))), F.get(sets, 0), F.array_intersect))


def centric(rows: DataFrame) -> DataFrame:
    """The microexon table from rows (key, coverage, p_spurious, candidates: array of struct(me, u2, cons)).

    Keys that share a candidate are a group (neighbours of a key, not a closure).  A group with common candidates gives one row: the
    candidate with the best score, summed coverage, keys and coverages in key order, the number of common candidates, and the least chance
    of a spurious match.
    """
    pairs = rows.select("key", F.explode("candidates").alias("c")).select("key", F.col("c.me").alias("me"))
    groups = neighbour_sets(pairs, "key", "me").withColumn("group", F.sha2(F.to_json("keys"), 256))
    members = groups.select("group", F.explode("keys").alias("key")).join(rows, "key")
    agg = members.groupBy("group").agg(
        F.sum("coverage").alias("sum_coverage"), F.min("p_spurious").alias("p_me"), F.array_sort(F.collect_list(F.struct("key", "coverage"))).alias("sjs"), F.array_sort(F.collect_list("candidates")).alias("sets")
    )
    agg = agg.withColumn("total", intersect_sets(F.col("sets"))).where(F.size("total") > 0)
    best = F.array_max(F.transform("total", lambda x: F.struct(x["u2"].alias("u2"), x["me"].alias("me"), x["cons"].alias("cons"))))
    return agg.withColumn("best", best).select(
        F.col("best.me").alias("me"), F.col("best.u2").alias("u2"), F.col("best.cons").alias("cons"), "sum_coverage",
        F.array_join(F.transform("sjs", lambda x: x["key"]), ",").alias("total_sjs"), F.array_join(F.transform("sjs", lambda x: x["coverage"].cast("string")), ",").alias("total_coverages"),
        F.size("total").cast("long").alias("n_matches"), "p_me", "total",
    )


