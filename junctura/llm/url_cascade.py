"""URL filters: longest-match host and path rules, then a Bloom filter cascade over the corpus's own keys.

The cascade answers membership in a list exactly for every key of a known universe.  Its first filter holds the listed keys; the second holds
the unlisted keys of the universe that the first wrongly accepts; the third the listed keys that the second accepts; and so on until
nothing is accepted wrongly.  A key's first rejecting level tells which side it is on.  Filters are literals in one expression over the key, so
judging a URL is a projection: no join, no shuffle.  A list too long for literals is dealt by hash into the cascades of a small table, one row for each part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch

_SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty if null or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def match_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits as a struct (rule, verdict), or null; of equally long ones the first by text."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        said = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, said) if out is None else out.when(fits, said)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def site(host: Column, labels: int = 3) -> Column:
    """The host's last ``labels`` labels."""
    return F.substring_index(host, ".", -labels)


def suffixes(host: Column) -> Column:
    """The host and what is left of it without its first label, its first two, and so on."""
    labels = F.split(host, r"\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))


class TooLong(ValueError):
    """A list that needs a longer filter than allowed."""


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]


@dataclass(frozen=True)
class Cascade:
    """Levels of alternating filters; without any nothing is listed."""

    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Is the key listed?  Exact for keys of the universe; false for null."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(~_accepts(self.levels[i], i, key), F.lit(i % 2 == 1)).otherwise(out)
        return F.coalesce(out, F.lit(False)) & key.isNotNull()


def _places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(1000 * level + j)), F.lit(bits).cast("long")) for j in range(hashes)]


def _accepts(f: Level, level: int, key: Column) -> Column:
    words = F.lit(list(f.words)) if len(f.words) < 8 else F.from_json(F.lit(str(list(f.words))), "array<long>")
    out = F.lit(True)
    for p in _places(key, level, f.bits, f.hashes):
        out = out & (F.getbit(F.get(words, F.floor(p / 64).cast("int")).cast("long"), (p % 64).cast("int")) == 1)
    return out


def _build(keys: DataFrame, count: int, level: int, rate: float, most: int) -> Level:
    """A filter of ``keys``: each key's bits are grouped into words, so only the words reach the driver."""
    bits = max(64, math.ceil(count * math.log2(1 / rate) / math.log(2)))
    if bits > most:
        raise TooLong(f"the filter of {count} keys takes {bits} bits, more than {most}; raise max_bits or use build_parted()")
    hashes = max(1, round(math.log2(1 / rate)))
    at = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits, hashes))).alias("p"))
    bit = F.expr("shiftleft(1L, cast(p % 64 as int))")
    got = at.groupBy(F.floor(F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(bit).alias("b")).collect()
    words = [0] * -(-bits // 64)
    for r in got:
        words[r["w"]] = r["b"]
    return Level(bits, hashes, tuple(words))


def build_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = 1 << 20) -> Cascade:
    """A cascade for the ``key`` column of ``listed`` over that of ``universe``; nulls and repeated keys are dropped.

    Listed keys that the universe lacks take part too.  A list whose first filter needs more than ``max_bits`` is refused with ValueError, since
    filters are literals of the plan; :func:`build_parted` serves such lists.
    """
    scratch = Scratch(listed.sparkSession, "cascade")
    yes = scratch.write(listed.select("key").where("key is not null").distinct(), "listed")
    no = scratch.write(universe.select("key").where("key is not null").distinct().join(yes, "key", "left_anti"), "unlisted")
    n, m = yes.count(), no.count()
    levels: list[Level] = []
    inside, outside = yes, no
    while n:
        rate = min(0.5, n / (math.sqrt(2) * m)) if not levels and m else 0.5
        levels.append(_build(inside, n, len(levels), rate, max_bits))
        wrong = scratch.write(outside.where(_accepts(levels[-1], len(levels) - 1, F.col("key"))), f"wrong{len(levels)}")
        inside, outside, n = wrong, inside, wrong.count()
    return Cascade(tuple(levels))


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class PartedCascade:
    """Cascades of the parts of a key space as a table (part, words): for each level an array of the filter's words; levels have equally many bits in all parts."""

    table: DataFrame
    parts: int
    levels: tuple[tuple[int, int], ...]  # bits and hashes

    def with_listed(self, keys: DataFrame) -> DataFrame:
        """``keys`` (key, ...) with ``listed``: each key meets its part's filters in one join with at most ``parts`` rows."""
        d = keys.withColumn("part", _part(F.col("key"), self.parts)).join(self.table, "part", "left")
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(~self.accepts(i, F.col("key"), F.col("words")), F.lit(i % 2 == 1)).otherwise(out)
        return d.withColumn("listed", F.coalesce(out, F.lit(False)) & F.col("key").isNotNull()).select(*keys.columns, "listed")

    def accepts(self, level: int, key: Column, words: Column) -> Column:
        bits, hashes = self.levels[level]
        out, own = F.lit(True), F.get(words, level)
        for p in _places(key, level, bits, hashes):
            out = out & (F.getbit(F.coalesce(F.get(own, F.floor(p / 64).cast("int")), F.lit(0).cast("long")), (p % 64).cast("int")) == 1)
        return out


def build_parted(listed: DataFrame, universe: DataFrame, part_bits: int = 1 << 20) -> PartedCascade:
    """Cascades for a list of any length: keys fall into parts by a hash, as many as keep a part's first filter at about ``part_bits``.

    Each level of all parts is built by one grouping and stays a table in the shared folder; nothing of it reaches the driver but counts.
    """
    scratch = Scratch(listed.sparkSession, "cascades")
    yes = scratch.write(listed.select("key").where("key is not null").distinct(), "listed")
    no = scratch.write(universe.select("key").where("key is not null").distinct().join(yes, "key", "left_anti"), "unlisted")
    n, m = yes.count(), no.count()
    rate = min(0.5, n / (math.sqrt(2) * m)) if m and n else 0.5
    parts = max(1, math.ceil(n * math.log2(1 / rate) / math.log(2) / part_bits))
    dealt = lambda d: d.withColumn("part", _part(F.col("key"), parts))
    inside, outside, levels = dealt(yes), dealt(no), []
    table = listed.sparkSession.range(parts).select(F.col("id").cast("int").alias("part"), F.array().cast("array<array<long>>").alias("words"))
    while n:
        i = len(levels)
        own = rate if not i else 0.5
        # room for the fullest part: any number of bits is exact, too few only cost a level
        bits = max(64, math.ceil(1.1 * n / parts * math.log2(1 / own) / math.log(2)))
        levels.append((bits, max(1, round(math.log2(1 / own)))))
        at = inside.select("part", F.explode(F.array(*_places(F.col("key"), i, *levels[-1]))).alias("p"))
        words = at.groupBy("part", F.floor(F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))
        none = table.select("part", F.explode(F.sequence(F.lit(0), F.lit(-(-bits // 64) - 1))).alias("w"), F.lit(0).cast("long").alias("b"))
        full = words.unionByName(none).groupBy("part", "w").agg(F.bit_or("b").alias("b")).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("w", "b"))).alias("f"))
        filters = full.select("part", F.transform("f", lambda x: x["b"]).alias("f"))
        table = scratch.write(table.join(filters, "part").select("part", F.concat("words", F.array("f")).alias("words")), f"level{i}")
        now = PartedCascade(table, parts, tuple(levels))
        wrong = outside.join(table, "part").where(now.accepts(i, F.col("key"), F.col("words"))).select("key", "part")
        wrong = scratch.write(wrong, f"wrong{i}")
        inside, outside, n = wrong, inside, wrong.count()
    return PartedCascade(table, parts, tuple(levels))


def judge_urls(pages: DataFrame, rules: list[Rule], listed: DataFrame, ident: str = "page_id", url: str = "url", max_bits: int = 1 << 20) -> DataFrame:
    """``ident``, host, path, rule, verdict, listed for every URL; a rule decides, else the list of sites blocks.

    A host is listed if it or any of its suffixes of whole labels is a listed key, however many labels the key has.  A list whose filters would exceed ``max_bits``
    (2**20 bits hold about 700 000 keys) is too long for literals: it is dealt into the cascades of :func:`build_parted`, which the distinct hosts' suffixes go through, with the
    same verdicts; hot hosts are dealt over salts.
    A null URL, or one without ``://``, has an empty host and path and is allowed unless a rule or the list says otherwise.  Repeated rows stay.
    """
    d = pages.select(F.col(ident).alias(ident), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    keys = d.select("host").distinct().select("host", F.explode(suffixes(F.col("host"))).alias("key"))
    try:
        cascade = build_cascade(listed, keys.select("key"), max_bits)
        d = d.withColumn("listed", F.exists(suffixes(F.col("host")), cascade.listed))
    except TooLong:
        known = build_parted(listed, keys.select("key"), max_bits).with_listed(keys).where("listed").select("host").distinct()
        known = known.select("host", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"), F.lit(True).alias("listed"))
        d = d.withColumn("salt", F.pmod(F.xxhash64(ident, "path"), F.lit(_SALTS)).cast("int")).join(known, ["host", "salt"], "left").drop("salt").withColumn("listed", F.coalesce("listed", F.lit(False)))
    d = d.withColumn("said", match_rule(rules, F.col("host"), F.col("path")))
    verdict = F.coalesce(F.col("said.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return d.select(ident, "host", "path", F.col("said.rule").alias("rule"), verdict.alias("verdict"), "listed")
