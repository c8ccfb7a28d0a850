"""Quality rules: base statistics of whole texts, and a decision list learned from labelled ones.

Everything is DataFrame expressions.  Sequential covering works on a bounded table of labelled statistics: each step asks Spark for
counts by feature and bin of the rows that the list does not cover yet, grows a conjunction of thresholds by information gain on two
thirds of them, prunes it on the other third, and keeps it if it is precise there.  The list becomes one ordered ``CASE`` expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch

_BLANKS = r"[\x20\x09-\x0D]+"
_WINDOW = 5


def base_statistics(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics of every whole text: ``ident``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_chars_text (long).

    A null text counts as empty.  Repeated windows of five words are found by 64-bit hashes, and those that share one are compared by their words.
    """
    d = docs.select(F.col(ident).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.select("id", "t", F.filter(F.split("t", _BLANKS), lambda w: w != "").alias("words"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        "words",
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
        (F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))).cast("long").alias("n_upper"),
        F.length("t").cast("long").alias("n_chars_text"),
    )
    grams = F.transform(F.sequence(F.lit(0), F.size("h") - _WINDOW), lambda i: F.xxhash64(*(F.get("h", i + j) for j in range(_WINDOW))))
    keep = ["id", "n_words", "word_chars", "n_symbols", "n_upper", "n_chars_text"]
    d = d.select(*keep, (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.when(F.size("h") >= _WINDOW, grams).alias("grams"), "words")
    keep.append("n_dup_lines")
    # windows in hash order, only where one repeats
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    d = d.select(*keep, F.when(repeats, F.array_sort(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"), F.when(repeats, F.col("words")).alias("words"))
    same = lambda k, j: F.get("s", k)["h"] == F.get("s", k + j)["h"]
    twice = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda k: F.coalesce(same(k, -1), F.lit(False)) | F.coalesce(same(k, 1), F.lit(False)))
    # of windows with one hash only those with the same words repeat
    d = d.select(*keep, F.array_sort(F.transform(twice, lambda k: F.struct(F.get("s", k)["h"].alias("h"), F.slice("words", F.get("s", k)["i"] + 1, F.lit(_WINDOW)).alias("w"), F.get("s", k)["i"].alias("i")))).alias("s"))
    alike = lambda k, j: (F.get("s", k)["h"] == F.get("s", k + j)["h"]) & (F.get("s", k)["w"] == F.get("s", k + j)["w"])
    twice = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda k: F.coalesce(alike(k, -1), F.lit(False)) | F.coalesce(alike(k, 1), F.lit(False)))
    starts = F.array_sort(F.transform(twice, lambda k: F.get("s", k)["i"]))
    first = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(starts, first, lambda a, x: F.struct((a["n"] + x + _WINDOW - F.greatest(a["end"], x)).alias("n"), (x + _WINDOW).alias("end")))["n"]
    row = F.struct(F.col("id").alias(ident), *keep[1:], F.coalesce(F.when(F.col("s").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"))
    # a generator: no filter above is pushed below it, where it would repeat the work inside the lambdas
    return d.select(F.inline(F.array(row)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Whole-number features of a row of statistics."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("n_chars_text", F.lit(1))
    whole = lambda x: F.floor(x).cast("long")
    return {
        "n_words": F.col("n_words"),
        "symbols_per_1000_words": whole(F.col("n_symbols") * 1000 / words),
        "tenths_of_letters_per_word": whole(F.col("word_chars") * 10 / words),
        "dup_lines": F.col("n_dup_lines"),
        "repeats_per_1000_words": whole(F.col("n_repeat_words") * 1000 / words),
        "capitals_per_1000_chars": whole(F.col("n_upper") * 1000 / chars),
    }


@dataclass(frozen=True)
class Literal:
    """``feature >= bound`` or ``feature < bound``."""

    feature: str
    at_least: bool
    bound: int

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] >= self.bound if self.at_least else of[self.feature] < self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.bound}"


@dataclass(frozen=True)
class Rules:
    """An ordered list of conjunctions; a text that fits one is rejected by the first such."""

    rules: tuple[tuple[Literal, ...], ...]

    def expression(self) -> Column:
        """The first fitting rule's text, or null: a conditional expression over the statistics."""
        of, out = features(), None
        for rule in self.rules:
            fits, said = _all(rule, of), " and ".join(map(str, rule))
            out = F.when(fits, said) if out is None else out.when(fits, said)
        return F.lit(None).cast("string") if out is None else out.otherwise(F.lit(None))


def _all(rule, of: dict[str, Column]) -> Column:
    out = F.lit(True)
    for x in rule:
        out = out & x.column(of)
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -1.0


def learn(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "quality", max_labelled: int = 20_000, bins: int = 24, max_rules: int = 8, max_literals: int = 3, precision: float = 0.95, support: int = 10) -> Rules:
    """Learn what labelled texts of low quality (label 0) have in common.

    At most ``max_labelled`` labelled documents are used, those with the smallest id hash; texts that fail the base rules, and labels that are null
    or contradict each other, are left out.  A rule must cover ``support`` low texts and reach ``precision`` on all its rows and on the pruning third.  Without
    low or without high labels the list is empty.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    known = labels.where(F.col(label).isNotNull() & F.col(ident).isNotNull()).groupBy(F.col(ident).alias("known")).agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z")
    known = known.select("known", (F.col("y") == 0).alias("low")).orderBy(F.xxhash64("known"), "known").limit(max_labelled)
    known = scratch.write(known, "known")  # bounded by max_labelled, so it may be broadcast
    used = docs.select(F.col(ident).alias("id"), F.col(text).alias("t")).join(F.broadcast(known), F.col("id") == F.col("known"))
    stats = base_statistics(used, "id", "t").join(F.broadcast(known), F.col("id") == F.col("known")).where(~base_failed())
    made = features()
    grow = F.pmod(F.xxhash64("id", F.lit("grow")), F.lit(3)) < 2
    rows = scratch.write(stats.select(*(c.alias(n) for n, c in made.items()), "low", grow.alias("grow")), "rows")

    share = F.lit([i / bins for i in range(1, bins)])
    cuts = rows.agg(*(F.percentile_approx(x, share, 1000).alias(f"{n}:{k}") for n in made for k, x in enumerate((F.col(n), F.when(F.col("low"), F.col(n)))))).first().asDict()
    bounds = {n: sorted({int(x) + d for k in range(2) for x in cuts[f"{n}:{k}"] or [] for d in (0, 1)}) for n in made}
    plain = {n: F.col(n) for n in made}
    # a feature's bin is the number of its bounds that a value reaches
    reached = lambda n, b: F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in b)), lambda x: x <= F.col(n))) if b else F.lit(0)
    binned = F.array(*(F.struct(F.lit(n).alias("f"), reached(n, b).alias("bin")) for n, b in bounds.items()))
    rows = scratch.write(rows.withColumn("binned", binned), "binned")

    found: list[tuple[Literal, ...]] = []
    left = rows
    while len(found) < max_rules:
        rule: list[Literal] = []
        while len(rule) < max_literals:
            here = left.where(_all(rule, plain)).where("grow")
            counts = here.select("low", F.explode("binned").alias("b")).groupBy("b.f", "b.bin").agg(F.count_if("low").alias("p"), F.count_if(~F.col("low")).alias("n")).collect()
            best, literal = 0.0, None
            for f, b in bounds.items():
                own = sorted((r["bin"], r["p"], r["n"]) for r in counts if r["f"] == f)
                p0, n0 = sum(r[1] for r in own), sum(r[2] for r in own)
                if not p0 or not n0:
                    continue
                for k, bound in enumerate(b):
                    p, n = sum(r[1] for r in own if r[0] > k), sum(r[2] for r in own if r[0] > k)
                    for x, y, up in ((p, n, True), (p0 - p, n0 - n, False)):
                        if x >= support and (g := _gain(x, y, p0, n0)) > best + 1e-9:
                            best, literal = g, Literal(f, up, bound)
            if literal is None:
                break
            rule.append(literal)
        if not rule:
            break
        # the prefix that does best on the pruning third
        sums = [x for i in range(1, len(rule) + 1) for x in (F.count_if(_all(rule[:i], plain) & F.col("low") & ~F.col("grow")), F.count_if(_all(rule[:i], plain) & ~F.col("low") & ~F.col("grow")), F.count_if(_all(rule[:i], plain) & F.col("low")), F.count_if(_all(rule[:i], plain) & ~F.col("low")))]
        got = left.agg(*(s.alias(f"c{i}") for i, s in enumerate(sums))).first()
        score = lambda i: (got[4 * i] - got[4 * i + 1]) / max(1, got[4 * i] + got[4 * i + 1])  # noqa: E731, B023
        best_i = max(range(len(rule)), key=lambda i: (score(i), -i))
        p, n, all_p, all_n = got[4 * best_i : 4 * best_i + 4]
        if all_p < support or all_p < precision * (all_p + all_n) or p < precision * (p + n):
            break
        found.append(tuple(rule[: best_i + 1]))
        left = scratch.write(left.where(~_all(found[-1], plain)), f"left{len(found)}")
    return Rules(tuple(found))


def judge(docs: DataFrame, rules: Rules, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Base statistics of every text with ``base_failed``, ``rule`` (the learned rule that rejects it, or null) and ``kept``.

    Rows stay apart even if equal; a null or empty text fails the base rules.
    """
    out = base_statistics(docs, ident, text).withColumn("base_failed", base_failed()).withColumn("rule", rules.expression())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
