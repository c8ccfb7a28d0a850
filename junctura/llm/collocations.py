"""Phrase collocations by level-wise passes: a phrase is counted only where both of its overlapping parts, a word shorter, are frequent.

Level k reads the texts once.  The frequent phrases of level k - 1 are broadcast as a table of bits, two bits of a hash for each, whose size follows their
number up to ``max_bits``; both parts of each k words in a text are looked up, and what passes is told apart by its own words, counted in
its chunk and summed by its text.  A false bit costs a count that comes out too small: results rest on counts alone, however full the table is.
Cuts are scored by joins of the level tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import rolling, slices, words
from .store import Scratch

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
CHUNK = 8 << 20
_SALTS = 64
_SLOT = 15  # a slot has 2**15 bits
_FACTORS = np.random.default_rng(23).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COUNTS = "lang string, phrase string, f long"
MAX_WORDS = len(_FACTORS)


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], np.uint64)


def _phrase_hashes(hashes: np.ndarray, start: np.ndarray, k: int, lang: np.ndarray) -> np.ndarray:
    """A hash of the ``k`` words from each place of ``start`` on, and of their language."""
    total = lang + np.uint64(k)
    for j in range(k):
        total = total + hashes[start + j] * _FACTORS[j]
    return rolling.mix(total)


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return hashes >> np.uint64(64 - bits), hashes & np.uint64((1 << bits) - 1)


def _counted(lang: np.ndarray, langs: list[str], w: words.Words, at: np.ndarray, k: int) -> pa.RecordBatch:
    """Number of occurrences of each (language, phrase of ``k`` words) that starts at one of the words ``at``."""
    used = np.zeros(len(w.begin), bool)
    for j in range(k):
        used[at + j] = True
    number = np.zeros(len(w.begin), np.int64)
    terms, number[used] = slices.distinct_slices(w.data, w.begin[used], w.stop[used])
    key, top = lang[w.doc[at]], len(langs)
    for j in range(k):
        if top * len(terms) >= 1 << 62:  # numbers of what is there, before they grow too large
            key, top = np.unique(key, return_inverse=True)[1], len(at)
        key, top = key * max(1, len(terms)) + number[at + j], top * len(terms)
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    like = at[first] if len(at) else at
    # words of a phrase and blanks between them, from one array
    begin, size = np.empty((len(like), 2 * k - 1), np.int64), np.ones((len(like), 2 * k - 1), np.int64)
    begin[:, 1::2] = len(w.data)
    for j in range(k):
        begin[:, 2 * j] = w.begin[like + j]
        size[:, 2 * j] = w.stop[like + j] - w.begin[like + j]
    phrase = words.strings(slices.take(np.append(w.data, np.uint8(0x20)), begin.ravel(), size.ravel()), size.sum(axis=1))
    where = pa.array(lang[w.doc[like]])
    return pa.record_batch([pa.array(langs, pa.string()).take(where), phrase, pa.array(times if len(at) else at)], ["lang", "phrase", "f"])


def _count(k: int, bits: int, frequent) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of a chunk's phrases of ``k`` words; at the first level also a row without phrase that counts all words."""
        known = None if frequent is None else np.frombuffer(frequent.value, np.uint8)
        for table in words.gather(batches, "text", CHUNK):
            lang, langs = words.encoded(table["lang"], "und")
            w = words.find(table["text"], _WORD)
            if k == 1:
                yield _counted(lang, langs, w, np.arange(len(w.begin)), 1)
                n = np.bincount(lang[w.doc], minlength=len(langs))
                yield pa.record_batch([pa.array(langs, pa.string()), pa.nulls(len(langs), pa.string()), pa.array(n.astype(np.int64))], ["lang", "phrase", "f"])
                continue
            breaks = np.concatenate([[0], np.cumsum(_BREAK[w.data])])[w.begin] + w.doc  # rises with each break and each document
            hashes, of_lang = w.hashes(), _lang_hashes(langs)
            start = np.flatnonzero(breaks[: len(breaks) - k + 2] == breaks[k - 2 :]) if len(breaks) >= k - 1 else np.zeros(0, np.int64)
            high, low = _places(_phrase_hashes(hashes, start, k - 1, of_lang[lang[w.doc[start]]]), bits)
            has = lambda p: (known[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
            part = np.zeros(len(w.begin) + 1, bool)
            part[start] = (has(high) & has(low)).astype(bool)
            n = max(0, len(w.begin) - k + 1)
            yield _counted(lang, langs, w, np.flatnonzero(part[:n] & part[1 : n + 1] & (breaks[:n] == breaks[k - 1 : k - 1 + n])), k)

    return count


def _slots(k: int, bits: int) -> Callable:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slots of the bit table with the bits of a batch's phrases, each of ``k`` words."""
        for batch in batches:
            lang, langs = words.encoded(pa.chunked_array([batch.column("lang")]), "und")
            w = words.find(pa.chunked_array([batch.column("phrase")]), _WORD)
            start = np.arange(0, len(w.begin), k)
            at = np.unique(np.concatenate(_places(_phrase_hashes(w.hashes(), start, k, _lang_hashes(langs)[lang]), bits))).astype(np.int64)
            slot, begin = np.unique(at >> _SLOT, return_index=True)
            blobs = []
            for own in np.split(at, begin[1:]) if len(at) else []:
                flags = np.zeros(1 << _SLOT, np.uint8)
                flags[own & ((1 << _SLOT) - 1)] = 1
                blobs.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.record_batch([pa.array(slot, pa.int32()), pa.array(blobs, pa.binary())], ["slot", "bits"])

    return send


def _united(table: pa.Table) -> pa.Table:
    rows = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
    return pa.table({"slot": table["slot"].slice(0, 1), "bits": pa.array([np.bitwise_or.reduce(rows).tobytes()], pa.binary())})


def _bit_table(level: DataFrame, k: int, max_bits: int):
    """The broadcast bits of a level's phrases and the logarithm of their number, or none where the level is empty."""
    n = level.count()
    if not n:
        return None, 0
    bits = min(max(_SLOT, int(16 * n).bit_length()), max_bits.bit_length() - 1)
    table = np.zeros((1 << bits - _SLOT, 1 << _SLOT - 3), np.uint8)
    # at most ``max_bits`` bits reach the driver
    for slot, blob in level.mapInArrow(_slots(k, bits), "slot int, bits binary").groupBy("slot").applyInArrow(_united, "slot int, bits binary").collect():
        table[slot] = np.frombuffer(blob, np.uint8)
    return level.sparkSession.sparkContext.broadcast(table.tobytes()), bits


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 100, most: int = 5, max_bits: int = 1 << 27) -> DataFrame:
    """lang, k, phrase, f: every phrase of 1 to ``most`` words that occurs ``min_count`` times or more in its language; with k = 0 a language's number of words.

    A-Z are lower-cased; words stand between blanks and tabs inside pieces, which end at ``[.,;:!?]`` and line ends; a phrase lies within one piece.
    A null language is ``und``, a null text empty; every row counts, repeated ones too.  A task holds a chunk of texts, or one longer text.
    """
    if not 1 <= most <= MAX_WORDS or min_count < 1 or max_bits < 1 << _SLOT:
        raise ValueError(f"1 to {MAX_WORDS} words, a count of 1 or more and 2**{_SLOT} bits or more")
    scratch = Scratch(docs.sparkSession, "collocations")
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    levels, frequent, bits = None, None, 0
    for k in range(1, most + 1):
        sums = rows.mapInArrow(_count(k, bits, frequent), _COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        level = scratch.write(sums.where(F.col("phrase").isNull() | (F.col("f") >= min_count)), f"level{k}")
        if frequent is not None:
            frequent.unpersist()
        level = level.select("lang", F.when(F.col("phrase").isNull(), 0).otherwise(k).alias("k"), "phrase", "f")
        levels = level if levels is None else levels.unionByName(level)
        frequent, bits = _bit_table(level.where(F.col("k") == k), k, max_bits) if k < most else (None, 0)
        if frequent is None:
            break
    return levels


def _joined(parts: Column, start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(parts, start, n), " ")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 100, most: int = 5, top: int = 2000, share: int = 100, max_bits: int = 1 << 27, salts: int = 16
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to ``most`` words.

    A cut behind the first words of a phrase scores floor(1000 a n / (l r)): a, l and r count the phrase and its two parts, n all words of the language.
    The lowest cut counts, of equal ones the first.  A phrase goes where a longer frequent one that holds it has ``share`` percent of its count.
    Order: score, then a, both falling, then phrase.  Sums are decimals of 38 digits.  See :func:`frequent_phrases` for texts and nulls.
    """
    levels = frequent_phrases(docs, lang, text, min_count, most, max_bits)
    n = levels.where("k = 0").select("lang", F.col("f").alias("n"))
    parts = levels.where(f"k between 1 and {most - 1}").select("lang", "phrase", "f")
    phrases = levels.where("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    longer = phrases.where("k >= 3")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: _joined(F.col("w"), i, m))))
    inside = longer.select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("within"))

    cuts = phrases.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _joined(F.col("w"), 1, F.col("cut")).alias("left"), _joined(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # a language may hold most phrases: its number of words comes to each of some salts
    n = n.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)).cast("int")).join(n, ["lang", "salt"])
    whole = lambda c: F.col(c).cast("decimal(19,0)").cast("decimal(38,0)")
    cuts = cuts.withColumn("above", F.lit(1000).cast("decimal(38,0)") * whole("a") * whole("n")).withColumn("below", whole("l") * whole("r"))
    lowest = F.min(F.struct(F.expr("above div below").alias("score"), "cut", "l", "r", "n")).alias("lowest")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).join(inside, ["lang", "phrase"], "left")
    scored = scored.where(F.col("within").isNull() | (F.lit(100) * F.col("within") < F.lit(share) * F.col("a"))).select("lang", "phrase", "a", "lowest.*")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each salt, then the first of these: no task sorts a whole language
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
