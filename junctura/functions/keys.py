"""Composite keys: parse once into structs, format only at the edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def me_id(chrom: Column, strand: Column, start: Column, end: Column) -> Column:
    """``chrom_strand_start_end``."""
    return F.concat_ws("_", chrom, strand, start.cast("string"), end.cast("string"))


def parse_me(ident: Column) -> Column:
    """Struct (chrom, strand, start, end) from an id; the chromosome may hold underscores."""
    at = lambda i: F.regexp_extract(ident, r"^(.*)_([+-])_(\d+)_(\d+)$", i)
    return F.when(ident.rlike(r"^.*_[+-]_\d+_\d+$"), F.struct(at(1).alias("chrom"), at(2).alias("strand"), at(3).cast("int").alias("start"), at(4).cast("int").alias("end")))


def sj_id(chrom: Column, strand: Column, start: Column, end: Column) -> Column:
    """``chrom:start+end``."""
    return F.concat(chrom, F.lit(":"), start.cast("string"), strand, end.cast("string"))


def parse_sj(ident: Column) -> Column:
    at = lambda i: F.regexp_extract(ident, r"^(.*):(\d+)([+-])(\d+)$", i)
    return F.when(ident.rlike(r"^.*:\d+[+-]\d+$"), F.struct(at(1).alias("chrom"), at(3).alias("strand"), at(2).cast("int").alias("start"), at(4).cast("int").alias("end")))


def coordinate(chrom: Column, start: Column, end: Column) -> Column:
    """1-based inclusive ``chrom:start-end``."""
    return F.concat(chrom, F.lit(":"), (start + 1).cast("string"), F.lit("-"), end.cast("string"))


def parse_region(region: Column) -> Column:
    """Struct (chrom, start, end), 0-based, from ``chr:1,000-2,000``."""
    at = lambda i: F.regexp_extract(region, r"^([^:]+):([0-9,]+)-([0-9,]+)$", i)
    number = lambda i: F.replace(at(i), F.lit(","), F.lit("")).cast("long")
    return F.when(region.rlike(r"^[^:]+:[0-9][0-9,]*-[0-9][0-9,]*$"), F.struct(at(1).alias("chrom"), (number(2) - 1).alias("start"), number(3).alias("end")))


def plain_name(name: Column) -> Column:
    """Blanks to underscores."""
    return F.replace(name, F.lit(" "), F.lit("_"))


def truth(text: Column) -> Column:
    """Booleans of configuration files."""
    return F.coalesce(F.lower(text).isin("yes", "true", "t", "1"), F.lit(False))
