"""Benchmark decontamination: windows of test items in a broadcast hash set, over which every window of the training texts is looked up.

Everything is DataFrame expressions.  The items' distinct windows form a table keyed by a 64-bit hash with the words beside it; its bytes are
measured, and it is broadcast in as many blocks of ``block_bytes`` as it needs.  A training text is split into words once for each block, its windows
are generated, hashed and probed inside one scan, and a hit counts only where the words are equal.  What leaves the scan is one row for each
text and one for each hit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: ASCII but digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_KEY = ["__first", "__second", "__part"]


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; none of a null one."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = 10) -> DataFrame:
    """Distinct windows of all items: h (long, hash of the words), n (int, words), alike (the windows of that hash, with their items' ids as text).

    An item of fewer than ``width`` words is one window, one without words none.  Ids may repeat; windows of an item without id
    have no id beside them.
    """
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(width))
    each = w.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))).alias("words"))
    known = each.groupBy("words").agg(F.collect_set("item").alias("items"))
    return known.groupBy(F.xxhash64("words").alias("h")).agg(F.max(F.size("words")).alias("n"), F.min(F.size("words")).alias("n_least"), F.collect_list(F.struct("words", "items")).alias("alike"))


def _found(docs: DataFrame, items: DataFrame, ident: str, text: str, item_id: str, item_text: str, width: int, block_bytes: int) -> DataFrame:
    """One row for each (id, text, partition): its number of equal rows, words, windows hit (start and number of words) and items."""
    scratch = Scratch(docs.sparkSession, "decontamination")
    known = scratch.write(item_windows(items, item_id, item_text, width), "windows")
    size = F.aggregate("alike", F.lit(0).cast("long"), lambda a, x: a + 32 + F.aggregate(F.concat(x["words"], x["items"]), F.lit(0).cast("long"), lambda b, w: b + 24 + F.octet_length(w)))
    total, lengths = known.agg(F.sum(size), F.array_distinct(F.concat(F.collect_set("n"), F.collect_set("n_least")))).first()  # as many lengths as ``width`` at most
    lengths = sorted(lengths, reverse=True) or [width]
    blocks = max(1, math.ceil((total or 0) / block_bytes))

    d = docs.select(F.col(ident).alias("__id"), F.col(text).alias("t"), words(F.col(text)).alias("w"))
    # a text's rows are told apart by id, two hashes and partition: a retried task gives the same, and equal rows without id stay spread
    d = d.select("__id", F.xxhash64("t").alias("__first"), F.xxhash64(F.lit(17), "t").alias("__second"), F.spark_partition_id().alias("__part"), "w")
    seen = None
    for block in range(blocks):
        rows = d.select("*", F.posexplode_outer("w").alias("at", "word")).drop("word").withColumn("at", F.coalesce("at", F.lit(0)))
        rows = rows.withColumn("n", F.lit(lengths[0])) if len(lengths) == 1 else rows.withColumn("n", F.explode(F.array(*map(F.lit, lengths))))
        window = F.when(F.col("at") + F.col("n") <= F.size("w"), F.slice("w", F.col("at") + 1, F.col("n")))
        rows = rows.withColumn("window", window).withColumn("key", F.when(F.col("window").isNotNull(), F.xxhash64("window")))
        mine = known.where(F.pmod("h", F.lit(blocks)) == block).select("h", "alike")
        rows = rows.join(F.broadcast(mine), F.col("key") == F.col("h"), "left")
        begin = (F.col("at") == 0) & (F.col("n") == lengths[0]) & F.lit(block == 0)
        rows = rows.where(begin | F.col("alike").isNotNull())
        hit = F.get(F.filter("alike", lambda x: x["words"] == F.col("window")), F.lit(0))
        rows = rows.select("__id", *_KEY, F.size("w").cast("long").alias("n_words"), begin.alias("begin"), "at", "n", hit["items"].alias("items"))
        seen = rows if seen is None else seen.unionByName(rows)
    at_hit = F.when(F.col("items").isNotNull(), F.struct(F.col("at").alias("start"), F.col("n").alias("n")))
    return seen.groupBy("__id", *_KEY).agg(
        F.count_if("begin").alias("rows"), F.max("n_words").alias("n_words"), F.collect_set(at_hit).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )


def _spans(found: DataFrame) -> DataFrame:
    """``hits`` as ``spans``: maximal runs of hit words as places from 0, end excluded."""
    hit = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1)))))
    found = found.withColumn("hit", F.when(F.size("hits") > 0, hit).otherwise(F.array().cast("array<int>")))
    starts = F.filter("hit", lambda x, i: (i == 0) | (F.coalesce(F.get("hit", i - 1), F.lit(-9)) != x - 1))
    ends = F.filter("hit", lambda x, i: F.coalesce(F.get("hit", i + 1), F.lit(-9)) != x + 1)
    return found.withColumn("spans", F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))).withColumn("n_hit", F.size("hit").cast("long"))


def find_contamination(
    docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 10, block_bytes: int = 32 << 20
) -> DataFrame:
    """One row for each row of ``docs``: ``ident``, n_words, n_hit (long, words inside a window of an item), items (ids as text, sorted), spans (runs of hit words), contaminated.

    A null text has no words.  Ids may be null or repeated, each row is judged by its own text; equal rows give equal rows.  Items without
    words have no windows; hits of an item without id count, but name no item.  Of other columns only those named are read.
    """
    found = _spans(_found(docs, items, ident, text, item_id, item_text, width, block_bytes))
    # equal rows of a partition were counted together
    found = found.withColumn("rows", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return found.select(F.col("__id").alias(ident), "n_words", "n_hit", "items", "spans", (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(
    docs: DataFrame, items: DataFrame, remove: str = "spans", ident: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 10, block_bytes: int = 32 << 20
) -> DataFrame:
    """The rows of ``docs`` without benchmark passages, with all their columns.

    ``remove`` says what goes: ``"spans"`` the hit words and what stands between them, with the texts else unchanged; ``"documents"`` every row with a hit.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    found = _found(docs, items, ident, text, item_id, item_text, width, block_bytes).where(F.size("hits") > 0)
    # equal texts have equal hits, whatever partition they were in
    found = _spans(found.groupBy("__first", "__second").agg(F.first("hits").alias("hits"))).select("__first", "__second", "spans")
    names = [f"c{i}" for i in range(len(docs.columns))]  # columns of any name may come in
    d = docs.toDF(*names)
    t = F.col(names[docs.columns.index(text)])
    d = d.withColumn("__first", F.xxhash64(t)).withColumn("__second", F.xxhash64(F.lit(17), t))
    if remove == "documents":
        return d.join(found, ["__first", "__second"], "left_anti").select(*names).toDF(*docs.columns)
    d = d.join(found, ["__first", "__second"], "left")
    # words and what is between them in turn; whether the first part is a word tells where word i stands
    parts = F.regexp_extract_all(t, F.lit(f"([^{_BETWEEN[1:-2]}]+|{_BETWEEN})"), F.lit(1))
    shift = F.when(F.regexp_like(t, F.lit(f"^{_BETWEEN}")), 1).otherwise(0)
    d = d.withColumn("__parts", F.when(F.col("spans").isNotNull(), parts)).withColumn("__shift", shift)
    before = lambda i: F.when(i == 0, 0).otherwise(2 * F.get("spans", i - 1)["end"] - 1 + F.col("__shift"))
    upto = lambda i: F.when(i == F.size("spans"), F.size("__parts")).otherwise(2 * F.get("spans", i)["start"] + F.col("__shift"))
    left = F.transform(F.sequence(F.lit(0), F.size("spans")), lambda i: F.array_join(F.slice("__parts", before(i) + 1, upto(i) - before(i)), ""))
    clean = F.when(F.col("spans").isNotNull(), F.array_join(left, "")).otherwise(t).cast(T.StringType())
    return d.select(*(clean.alias(c) if c == names[docs.columns.index(text)] else F.col(c) for c in names)).toDF(*docs.columns)
