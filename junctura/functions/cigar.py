"""CIGAR strings and SAM flags as expressions: folds over arrays of (op, len)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPS = r"(\d+)(\D)"


def parse(cigar: Column) -> Column:
    """Array of struct (op, len)."""
    lens, ops = F.regexp_extract_all(cigar, F.lit(OPS), F.lit(1)), F.regexp_extract_all(cigar, F.lit(OPS), F.lit(2))
    return F.zip_with(ops, lens, lambda o, n: F.struct(o.alias("op"), n.cast("int").alias("len")))


def text(ops: Column) -> Column:
    return F.array_join(F.transform(ops, lambda x: F.concat(x["len"].cast("string"), x["op"])), "")


def reverse(ops: Column) -> Column:
    return F.reverse(ops)


def length_of(ops: Column, kinds: str) -> Column:
    """Summed length of the operations in ``kinds``."""
    return F.aggregate(ops, F.lit(0), lambda a, x: a + F.when(x["op"].isin(*kinds), x["len"]).otherwise(0))


def count_of(ops: Column, kinds: str) -> Column:
    return F.size(F.filter(ops, lambda x: x["op"].isin(*kinds)))


def tag_score(ops: Column) -> Column:
    """Matches and insertions less one for each deletion."""
    return length_of(ops, "MI") - count_of(ops, "D")


def genome_score(ops: Column) -> Column:
    """Matches less inserted bases and one for each deletion."""
    return length_of(ops, "M") - length_of(ops, "I") - count_of(ops, "D")


def _blocks(start: Column, ops: Column, cut: str, forward: str) -> Column:
    kind = "struct<done:array<struct<start:int,end:int>>,start:int,end:int>"
    first = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"), start.cast("int").alias("start"), start.cast("int").alias("end")).cast(kind)

    def step(a, x):
        after = a["end"] + x["len"]
        closed = F.concat(a["done"], F.array(F.struct(a["start"].alias("start"), a["end"].alias("end"))))
        cutting = F.struct(closed.alias("done"), after.alias("start"), after.alias("end"))
        going = F.struct(a["done"].alias("done"), a["start"].alias("start"), after.alias("end"))
        return F.when(x["op"].isin(*cut), cutting).when(x["op"].isin(*forward), going).otherwise(a).cast(kind)

    return F.aggregate(ops, first, step, lambda a: F.concat(a["done"], F.array(F.struct(a["start"].alias("start"), a["end"].alias("end")))))


def exon_blocks(start: Column, ops: Column) -> Column:
    """Genomic blocks of an alignment: matches and deletions go on, N begins a new block."""
    return _blocks(start, ops, "N", "MD")


def query_blocks(ops: Column) -> Column:
    """Query blocks: matches and deletions go on, an insertion begins a new block behind itself."""
    return _blocks(F.lit(0), ops, "I", "MD")


def introns(blocks: Column) -> Column:
    """Gaps between neighbouring blocks."""
    pairs = F.zip_with(F.slice(blocks, F.lit(1), F.greatest(F.size(blocks) - 1, F.lit(0))), F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0))), lambda a, b: F.struct(a["end"].alias("start"), b["start"].alias("end")))
    return F.when(F.size(blocks) > 1, pairs).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def strand(flag: Column, paired: bool = False) -> Column:
    """Strand of a read; of a pair, the strand of the fragment by its first mate."""
    reverse = flag.bitwiseAND(16) != 0
    if paired:
        reverse = F.when(flag.bitwiseAND(128) != 0, ~reverse).otherwise(reverse)
    return F.when(reverse, "-").otherwise("+")


def protocol_strand(flag: Column, protocol: str) -> Column:
    """Strand by library protocol: ``NONE``, ``SENSE``, ``ANTISENSE``, ``MATE1_SENSE`` or ``MATE2_SENSE``."""
    plain = flag.bitwiseAND(16) == 0
    first, second = flag.bitwiseAND(64) != 0, flag.bitwiseAND(128) != 0
    sense = {
        "NONE": F.lit(True),
        "SENSE": plain,
        "ANTISENSE": ~plain,
        "MATE1_SENSE": F.when(first, plain).when(second, ~plain).otherwise(plain),
        "MATE2_SENSE": F.when(first, ~plain).when(second, plain).otherwise(plain),
    }[protocol]
    return F.when(sense, "+").otherwise("-")
