"""Source divergence audit: how far the sources of a language lie apart in their use of its terms, and which terms set a source off.

Counts of (language, source, term) are dense tiles, a block of a language's terms against its sources, in whole numbers.  A tile's task compares all
its sources at once, term by term, and gives a partial matrix over pairs of sources and each source's best terms of the block; partial matrices are
summed and the short lists merged.  Blocks are of bounded width, and where a language has more sources than a tile is high, each task holds two tiles of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import slices, words
from .store import Scratch

#: Bytes of terms: ASCII letters (lower-cased by then) and all bytes of other characters.
_TERM = np.zeros(256, bool)
_TERM[0x61:0x7B] = _TERM[0x80:] = True
CHUNK = 8 << 20
_COUNTS = "lang string, source string, term string, n long, docs long"
_PARTS = "lang string, source string, part string, item string, value long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term of each (language, source) of a chunk, and one row without term for each (language, source)."""
    for table in words.gather(batches, "text", CHUNK):
        lang, langs = words.encoded(table["lang"], "")
        source, sources = words.encoded(table["source"], "")
        group = lang * len(sources) + source
        w = words.find(table["text"], _TERM)
        terms, term = slices.distinct_slices(w.data, w.begin, w.stop)
        width = max(1, len(terms))
        own, times = np.unique(w.doc * width + term, return_counts=True)  # of a document
        keys, place = np.unique(group[own // width] * width + own % width, return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, place, times)
        docs = np.bincount(place, minlength=len(keys))
        every = np.unique(group)
        at = np.concatenate([keys // width, every])
        size = np.array([len(t) for t in terms], np.int64)
        text = words.strings(np.frombuffer(b"".join(terms), np.uint8), size).take(pa.array(np.concatenate([keys % width, np.zeros(len(every), np.int64)]), mask=np.arange(len(at)) >= len(keys)))
        zero = np.zeros(len(every), np.int64)
        yield pa.record_batch(
            [pa.array(langs, pa.string()).take(pa.array(at // len(sources))), pa.array(sources, pa.string()).take(pa.array(at % len(sources))), text, pa.array(np.concatenate([n, zero])), pa.array(np.concatenate([docs, zero]))],
            ["lang", "source", "term", "n", "docs"],
        )


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """floor(10**9 * count / total) for whole numbers 0 <= count <= total < 9 * 10**15, exact: three decimals at a time."""
    out, left = np.zeros(np.broadcast_shapes(np.shape(count), np.shape(total)), np.int64), count
    for _ in range(3):
        left = left * 1000
        step = left // total
        left = left - step * total
        out = out * 1000 + step
    return out


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _tile(top: int):
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        """Of one block of terms and two tiles of sources: partial sums of pairs, and, of a tile with itself, each source's ``top`` terms."""
        lang, _, first, second = (k.as_py() for k in key)
        whole, parts = table.filter(pc.is_null(table["term"])), table.filter(pc.is_valid(table["term"]))
        names = whole["source"].to_pylist()
        row_of = {s: i for i, s in enumerate(names)}
        side = whole["tile"].to_numpy()
        v, total = (whole[c][0].as_py() for c in ("v", "lang_n"))
        base = whole["n"].to_numpy() + 2 * v
        terms, column = np.unique(np.array(parts["term"].cast(pa.binary()).to_pylist(), object), return_inverse=True)  # in byte order
        source, n = parts["source"], parts["n"].to_numpy()
        every = pc.is_null(source).to_numpy(zero_copy_only=False)
        row = np.array([row_of[s] for s in source.filter(pa.array(~every)).to_pylist()], np.int64)
        count = np.zeros((len(names), len(terms)), np.int64)
        count[row, column[~every]] = n[~every]
        of_lang = np.zeros(len(terms), np.int64)
        of_lang[column[every]] = n[every]
        p = 1 + shares(count + 2, np.maximum(base, 1)[:, None])
        out: list[tuple] = []
        for i in np.flatnonzero(side == first).tolist():
            others = np.flatnonzero(side == second)
            if first == second:
                others = others[others > i]
            out += [(names[i], "pair", names[j], f) for j, f in zip(others.tolist(), _apart(p[others], p[i]).sum(axis=1).tolist(), strict=True)]
        if first == second:
            q = 1 + shares(of_lang + 2, max(1, total + 2 * v))
            for i, s in enumerate(names):
                mine = np.flatnonzero((count[i] > 0) & (p[i] > q))
                f = _apart(p[i, mine], q[mine])
                best = np.argsort(-f, kind="stable")[:top]  # equal ones in byte order
                out += [(s, "term", terms[mine[b]].decode("utf-8", "replace"), int(f[b])) for b in best.tolist()]
        s, part, item, value = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(s, pa.string()), "part": pa.array(part, pa.string()), "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})

    return compare


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10, top: int = 10, block_terms: int = 4096, tile_sources: int = 256) -> DataFrame:
    """lang, source, part, item, value (long), rank (int): part ``pair`` has the other sources of the language, part ``term`` the source's ``top`` terms.

    Terms are runs of letters with A-Z lower-cased; a language keeps those of at least ``min_docs`` rows.  A term's share in a source, or in the whole language,
    is p = 1 + floor(10**9 (count + 2) / (N + 2 V)), N the count of all V kept terms; two shares differ by floor((p - q)**2 / (p + q)).  A pair's value
    sums that over all kept terms; a term's compares source and language where the source uses it more.  Ranks go by falling value, then by item.

    Nulls read as ''.  Every row is a document, repeated ones too.  A source without terms has its pairs; a language without kept terms has pairs of value 0;
    an empty table gives no rows.  Other columns are not read.  A task holds a chunk of texts (or one longer text) or a tile of counts.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    rows = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    counted = rows.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    kept = counted.withColumn("all_docs", F.sum("docs").over(same)).withColumn("all_n", F.sum("n").over(same)).withColumn("lead", F.row_number().over(same.orderBy("source")) == 1)
    kept = scratch.write(kept.where(F.col("term").isNull() | (F.col("all_docs") >= min_docs)).select("lang", "source", "term", "n", "all_n", "lead"), "kept")

    is_term = F.col("term").isNotNull()
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.when(is_term & F.col("lead"), 1).otherwise(0)).alias("led"))
    of_lang = Window.partitionBy("lang")
    groups = groups.select("lang", "source", "n", F.sum("led").over(of_lang).alias("v"), F.sum("n").over(of_lang).alias("lang_n"), F.row_number().over(of_lang.orderBy("source")).alias("at"), F.count("*").over(of_lang).alias("g"))
    tile = ((F.col("at") - 1) / tile_sources).cast("int")
    ceil = lambda x, n: F.ceil(F.col(x) / n).cast("int")
    groups = scratch.write(groups.select("lang", "source", "n", "v", "lang_n", tile.alias("tile"), F.greatest(ceil("v", block_terms), F.lit(1)).alias("blocks"), ceil("g", tile_sources).alias("tiles")), "groups")

    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    two = [F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b")]
    none = F.lit(None)
    found = kept.where(is_term).join(groups.select("lang", "source", "tile", "blocks", "tiles"), ["lang", "source"])
    found = found.select("lang", "source", "term", "n", "tile", block, other).select("lang", "block", *two, "source", "term", "n", "tile", none.cast("long").alias("v"), none.cast("long").alias("lang_n"))
    langs = groups.groupBy("lang").agg(F.max("blocks").alias("blocks"), F.max("tiles").alias("tiles"))
    totals = kept.where(is_term & F.col("lead")).join(langs, "lang").select("lang", "term", "all_n", block, other, "tiles")
    totals = totals.select("lang", "block", "term", "all_n", "other", F.explode(F.sequence(F.col("other"), F.col("tiles") - 1)).alias("b"))
    totals = totals.select("lang", "block", F.col("other").alias("a"), "b", none.cast("string").alias("source"), "term", F.col("all_n").alias("n"), none.cast("int").alias("tile"), none.cast("long").alias("v"), none.cast("long").alias("lang_n"))
    sides = groups.select("lang", "source", "n", "v", "lang_n", "tile", "tiles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    sides = sides.select("*", other).select("lang", "block", *two, "source", none.cast("string").alias("term"), "n", "tile", "v", "lang_n")
    parts = scratch.write(found.unionByName(totals).unionByName(sides).groupBy("lang", "block", "a", "b").applyInArrow(_tile(top), _PARTS), "parts")

    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "item", "part").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x")
    pairs = pairs.select("lang", "part", "value", both).select("lang", "x.source", "part", "x.item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    best = parts.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best).select("lang", "source", "part", "item", "value", "rank")
