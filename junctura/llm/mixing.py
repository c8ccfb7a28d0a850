"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling by calibrated probabilities.

Documents fall into cells by source, language and topic.  Raking finds a factor for each source, each language and each topic such that the
cells' tokens times their factors meet the target share of every margin.  Cells are grouped once; the factors are small tables, and each half
step is one join and one grouping of the cell table, written to the shared folder.  A document's probability is its cell's factor relative to
the largest one, so that all stay at most 1 and the sample keeps the margins in expectation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch

NONE = "(none)"
#: Factor tables of up to so many keys are written as one file each half step.
ONE_FILE = 100_000


def tokens(text: Column) -> Column:
    """Words of a text, null as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def surface_topic(text: Column) -> Column:
    """The default topic: a text's form, by fixed signs."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.contains(" | "), "table").when(t.rlike("[#*$%&<>]{2}"), "markup").when(t.rlike("[0-9]{6}"), "figures").when(t.rlike("[A-Z]{4}"), "capitals").otherwise("prose")


def cells(docs: DataFrame, topic: Column, text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """Columns added to each document: cell keys ``m_source, m_lang, m_topic`` (null as ``(none)``) and ``m_tokens``."""
    some = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    return docs.withColumns({"m_source": some(F.col(source)), "m_lang": some(F.col(lang)), "m_topic": some(topic), "m_tokens": tokens(F.col(text))})


def _scalar(table: DataFrame, of: Column) -> Column:
    """One number of a whole table as a literal; null for an empty one."""
    return F.lit(table.agg(of).first()[0]).cast("double")


def tempered(table: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares in proportion to a power of the tokens: (key, target)."""
    by = table.groupBy(margin).agg(F.sum("tokens").alias("n")).where("n > 0").select(F.col(margin).alias("key"), F.pow("n", F.lit(power)).alias("w"))
    return by.select("key", (F.col("w") / _scalar(by, F.sum("w"))).alias("target"))


def rake(table: DataFrame, targets: dict[str, DataFrame], rounds: int, scratch: Scratch, tolerance: float = 1e-9) -> DataFrame:
    """The cell table (margins, tokens) with ``factor``: tokens * factor meets each margin's target share of 1.

    ``targets`` maps a margin's column to (key, target).  A key without target gets factor 0; one without tokens is left out, and the others
    share its target in proportion.  Ends after ``rounds``, or as soon as no factor moves by more than ``tolerance`` of itself.
    """
    factors, small = {}, {}
    for m, t in targets.items():
        held = table.where("tokens > 0").select(F.col(m).alias("key")).distinct().join(t, "key")
        shares = held.select("key", (F.col("target") / _scalar(held, F.sum("target"))).alias("target"), F.lit(1.0).alias("f"))
        factors[m] = scratch.write(shares, f"{m}-0")
        small[m] = factors[m].count() <= ONE_FILE

    def weighed(names) -> DataFrame:
        out = table
        for m in names:
            out = out.join(factors[m].select(F.col("key").alias(m), F.col("f").alias(f"f_{m}")), m, "left")
        product = F.lit(1.0)
        for m in names:
            product = product * F.coalesce(f"f_{m}", F.lit(0.0))
        return out.withColumn("product", product)

    for step in range(1, rounds + 1):
        moved = 0.0
        for m in targets:
            others = [x for x in targets if x != m]
            sums = weighed(others).groupBy(F.col(m).alias("key")).agg(F.sum(F.col("tokens") * F.col("product")).alias("s"))
            after = factors[m].join(sums, "key", "left").select("key", "target", F.when(F.col("s") > 0, F.col("target") / F.col("s")).otherwise(0.0).alias("f"), F.col("f").alias("was"))
            after = scratch.write(after.coalesce(1) if small[m] else after, f"{m}-{step}")
            moved = max(moved, after.agg(F.max(F.abs(F.col("f") - F.col("was")) / F.greatest("f", F.lit(1e-300)))).first()[0] or 0.0)
            factors[m] = after.select("key", "target", "f")
        if moved <= tolerance:
            break
    return scratch.write(weighed(list(targets)).select(*targets, "tokens", F.col("product").alias("factor")), "factors")


def uniform(ident: Column, text: Column, seed: int) -> Column:
    """A number in 0..1 from an id, or from the text where there is none: the same for every run, engine and partitioning."""
    name = F.coalesce(ident.cast("string"), F.concat(F.lit(NONE), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat_ws(":", name, F.lit(str(seed)))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**48))


def mix(docs: DataFrame, topic: Column | None = None, powers: tuple[float, float, float] = (0.5, 0.7, 1.0), targets: dict[str, DataFrame] | None = None, rounds: int = 8, seed: int = 42, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Rake token weights to source, language and topic margins and sample documents.

    Targets are tables (key, target) for ``m_source``, ``m_lang`` and ``m_topic``, or tempered shares by ``powers`` where none is given.  Returns the
    input columns with ``m_source, m_lang, m_topic, m_tokens, factor, probability, sampled`` (they replace columns of these names).  Documents without
    words have probability 1, since they weigh nothing; those of a cell without target have 0.  Equal ids are sampled alike, rows without id by
    their texts, so that equal texts without id are sampled alike.
    """
    made = ["m_source", "m_lang", "m_topic", "m_tokens", "factor", "probability", "sampled"]
    docs = docs.select(*(c for c in docs.columns if c not in made))
    scratch = Scratch(docs.sparkSession, "mixing")
    dealt = cells(docs, surface_topic(F.col(text)) if topic is None else topic, text)
    margins = ["m_source", "m_lang", "m_topic"]
    table = scratch.write(dealt.groupBy(*margins).agg(F.sum("m_tokens").alias("tokens")), "cells")
    targets = {m: (targets or {}).get(m) or tempered(table, m, p) for m, p in zip(margins, powers, strict=True)}
    raked = rake(table, targets, rounds, scratch)
    top = _scalar(raked.where("tokens > 0"), F.max("factor"))
    rates = raked.select(*margins, "factor", F.when(F.col("tokens") > 0, F.col("factor") / top).otherwise(1.0).alias("__rate"))
    out = dealt.join(scratch.write(rates, "rates"), margins)
    out = out.withColumn("probability", F.when(F.col("m_tokens") > 0, F.col("__rate")).otherwise(1.0)).drop("__rate")
    return out.withColumn("sampled", uniform(F.col(ident), F.col(text), seed) < F.col("probability")).select(*docs.columns, *made)
