"""Lines of large gzip files in many tasks: files of several members, blocked gzip among them, are cut where a member begins.

A task takes the members that begin in its stretch of the file, and the lines that begin in them; the line that goes on behind them it reads to its end, as the next task
leaves out what stands in front of its first line feed.  A file of one member is one task, whatever its size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import binary

SCHEMA = "file string, split long, row long, value string"
_MAGIC, _READ, _BATCH = b"\x1f\x8b\x08", 1 << 20, 4 << 20


def _inflated(r: binary.Ranges, at: int, stop: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(member, data) from the member at an offset on, up to the first that begins at or behind ``stop``; checksums are verified."""
    while at < r.size and (stop is None or at < stop):
        press, begin, read = zlib.decompressobj(31), at, at
        while not press.eof:
            chunk = r.read(read, _READ)
            if not chunk:
                raise ValueError("the file ends inside a gzip member")
            read += len(chunk)
            data = press.decompress(chunk)
            if data:
                yield begin, data
        at = read - len(press.unused_data)
        # writers may pad with zeros behind the last member
        if r.read(at, 1) == b"\0":
            return


def _is_member(r: binary.Ranges, at: int) -> bool:
    """Does a whole member begin here?  Bytes that only look like a header fail within a few blocks, or by their checksum."""
    head = r.read(at, 10)
    if len(head) < 10 or head[3] & 0xE0:
        return False
    try:
        for _ in _inflated(r, at, at + 1):
            pass
    except (zlib.error, ValueError):
        return False
    return True


def first_member(r: binary.Ranges, at: int, stop: int) -> int | None:
    """Offset of the first member that begins in ``at:stop``."""
    while at < stop:
        window = r.read(at, min(_READ, stop - at) + 2)
        i = window.find(_MAGIC)
        while i >= 0:
            if at + i < stop and _is_member(r, at + i):
                return at + i
            i = window.find(_MAGIC, i + 1)
        at += _READ
    return None


@dataclass
class _Part(InputPartition):
    def __init__(self, uri: str, begin: int, end: int):
        super().__init__(uri)
        self.uri, self.begin, self.end = uri, begin, end


def _lines(r: binary.Ranges, first: int, end: int, whole: bool) -> Iterator[bytes]:
    """Stretches of whole lines of the members from ``first`` to ``end``, without a partial line in front unless ``whole``."""
    held, skipping, inside = b"", not whole, True
    for member, data in _inflated(r, first):
        if inside and member >= end:
            inside = False
        if not inside:
            # the line that began before the border goes on here, to its end
            cut = data.find(b"\n")
            if cut < 0:
                held += data
                continue
            if not skipping:
                yield held + data[: cut + 1]
            return
        if skipping:
            cut = data.find(b"\n")
            if cut < 0:
                continue
            data, skipping = data[cut + 1 :], False
        held += data
        if len(held) >= _BATCH:
            cut = held.rfind(b"\n") + 1
            if cut:
                yield held[:cut]
                held = held[cut:]
    if held and not skipping:
        yield held


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.split = options["path"], int(options.get("splitbytes", str(64 << 20)))

    def partitions(self):
        return [_Part(uri, b, min(b + self.split, size)) for uri, size in binary.files(self.path, ".gz") for b in range(0, size, self.split)] or [_Part("", 0, 0)]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        if not part.uri:
            return
        with binary.Ranges(part.uri) as r:
            first = 0 if not part.begin else first_member(r, part.begin, part.end)
            if first is None:
                return
            done = 0
            for text in _lines(r, first, part.end, not part.begin):
                rows = text.removesuffix(b"\n").split(b"\n")
                rows = [x.removesuffix(b"\r") for x in rows]
                n = len(rows)
                same = lambda v, t: pa.array(np.full(n, v), t)  # noqa: E731, B023
                value = pa.array(rows, pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([part.uri] * n), same(part.begin, pa.int64()), pa.array(np.arange(done, done + n)), value], ["file", "split", "row", "value"])
                done += n


class GzLinesSource(DataSource):
    """``spark.read.format("gzlines")``: a gzip file or a folder of ``.gz`` files as (file, split, row, value), ``row`` the line's number in its split.  Option ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "gzlines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def gz_lines(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """(file, split, row, value): the lines of gzip files, cut at members."""
    spark.dataSource.register(GzLinesSource)
    return spark.read.format("gzlines").option("splitBytes", split_bytes).load(path)


def gz_table(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """A headered tab-separated table of gzip files, all columns text; the header of the first file names the columns, and every file's own is left out."""
    uri, size = binary.files(path, ".gz")[0]
    with binary.Ranges(uri) as r:
        head = next(_lines(r, 0, size, True), b"").split(b"\n", 1)[0].removesuffix(b"\r").decode()
    names = head.split("\t")
    lines = gz_lines(spark, path, split_bytes).where("not (split = 0 and row = 0)").select(F.split("value", "\t", -1).alias("f"))
    return lines.select(*(F.nullif(F.get("f", i), F.lit("")).alias(n) for i, n in enumerate(names)))
