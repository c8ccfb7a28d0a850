"""Nucleotide sequence expressions.  Positions are 0-based and half-open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice_seq(seq: Column, start: Column, end: Column) -> Column:
    """``seq[start:end]``, empty where the range is; null where it leaves the sequence on the left."""
    return F.when(start >= 0, F.substr(seq, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int")))


def revcomp(seq: Column) -> Column:
    """Reverse complement; case is kept, other letters stay."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def stranded(seq: Column, strand: Column) -> Column:
    """The sequence as its strand reads it."""
    return F.when(strand == "-", revcomp(seq)).otherwise(seq)


def splice_dinucleotides(intron: Column) -> Column:
    """First two and last two bases of an intron."""
    return F.concat(F.substring(intron, 1, 2), F.substring(intron, -2, 2))


def canonical(dinucleotides: Column) -> Column:
    return dinucleotides.isin("GTAG", "GCAG", "ATAC")


def overlapping(seq: Column, pattern: Column) -> Column:
    """Array of the 0-based places of all occurrences of ``pattern``, overlapping ones too.

    The sequence is split in front of each occurrence, in one pass; the places are the running lengths of the parts.
    """
    parts = F.split(seq, F.concat(F.lit("(?=\\Q"), pattern, F.lit("\\E)")))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda a, x: F.struct((a["at"] + F.length(x)).alias("at"), F.concat(a["out"], F.array(a["at"] + F.length(x))).alias("out"))
    inner = F.aggregate(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), first, step, lambda a: a["out"])
    front = F.when(F.startswith(seq, pattern), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return F.when(F.length(pattern) > 0, F.concat(front, inner)).otherwise(F.array().cast("array<int>"))


def count_apart(seq: Column, pattern: Column) -> Column:
    """Number of occurrences that do not overlap, from the left."""
    return F.when(F.length(pattern) > 0, ((F.length(seq) - F.length(F.replace(seq, pattern, F.lit("")))) / F.length(pattern)).cast("long")).otherwise(F.lit(0).cast("long"))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    n = F.least(F.length(a), F.length(b))
    first = F.array_position(same, False).cast("int")
    return F.when(n == 0, 0).when(first == 0, n).otherwise(F.least(first - 1, n)).cast("int")


def direct_repeat_up(up: Column, found: Column) -> Column:
    """How far an insertion of ``found`` behind ``up`` may move left: its length and the suffix common with ``up``; 0 if longer than ``up``."""
    shared = common_prefix(F.reverse(up), F.reverse(F.concat(up, found)))
    return F.when(F.length(found) <= F.length(up), F.length(found) + shared).otherwise(F.lit(0)).cast("int")


def direct_repeat_down(down: Column, found: Column) -> Column:
    """How far it may move right: the prefix common to ``found + down`` and ``down``."""
    return common_prefix(F.concat(found, down), down)


def spurious_denovo(length: Column, intron: Column) -> Column:
    """Chance that an intron of this length holds AG + a given sequence + GT by accident."""
    return 1 - F.pow(1 - F.pow(F.lit(4.0), -(length + 4)), intron - (length + 4))


def spurious_annotated(length: Column, intron: Column) -> Column:
    """The same for annotated exons, with the annotated table's formula: 4**L + 4 in place of 4**(L + 4)."""
    return 1 - F.pow(1 - 1 / (F.pow(F.lit(4.0), length) + 4), intron - (length + 4))


def pwm_sum(window: Column, matrix: list[dict[str, float]]) -> Column:
    """Sum of a window's values in a position weight matrix; other letters and missing places count 0."""
    total = F.lit(0.0)
    for i, row in enumerate(matrix):
        base = F.substring(window, i + 1, 1)
        value = F.lit(0.0)
        for nt, p in row.items():
            value = F.when(base == nt, F.lit(p)).otherwise(value)
        total = total + value
    return total


def pwm_score(window: Column, matrix: list[dict[str, float]]) -> Column:
    """Percent of a matrix's best sum that a window reaches; a window of another length gives null."""
    return F.when(F.length(window) == len(matrix), 100 * pwm_sum(window, matrix) / pwm_best(matrix))


def pwm_best(matrix: list[dict[str, float]]) -> float:
    """The largest sum a window can reach."""
    return sum(max(row.values()) for row in matrix)


def repair_quality(seq: Column, qual: Column, pad: str = "#") -> Column:
    """Qualities cut or padded to the sequence's length."""
    return F.substr(F.rpad(qual, F.greatest(F.length(seq), F.length(qual), F.lit(1)), pad), F.lit(1), F.length(seq))


def intron_ends(intron: Column, length: Column) -> Column:
    """An intron's first and last ``length`` bases."""
    return F.array(F.substr(intron, F.lit(1), length), F.right(intron, length))
