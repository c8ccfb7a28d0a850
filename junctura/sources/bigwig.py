"""bigWig files: values of intervals, such as conservation, behind a chromosome tree and an R-tree of compressed blocks.

Three ways in: ``spark.read.format("bigwig")`` for the whole file or what its filters leave, :func:`blocks` for the index as a table, and
:func:`values` for the blocks that given regions touch.  The planner goes down the R-tree only until it has enough subtrees to deal out; the rest
of the index is walked by tasks.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..operators.intervals import mean_value
from . import binary

# Fixed values of the format.
_MAGIC, _CHROM_MAGIC, _INDEX_MAGIC = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
_HEADER, _SECTION, _NODE = "IHHQQQHHQQIQ", "IIIIIBBH", "BBH"
_FANOUT, _ITEMS = 256, 1024
VALUES = "chrom string, start int, end int, value double"
BLOCKS = "file string, chrom string, start long, end long, offset long, bytes long, packed boolean, swapped boolean"
_GAP = 64 << 10
_TASK_BYTES = 4 << 20


@dataclass
class Node:
    """A child of an index node: what it spans, by chromosome number and base, and where it is; ``size`` is a block's, None for an inner node."""

    lo: tuple[int, int]
    hi: tuple[int, int]
    at: int
    size: int | None


class BigWig:
    """The header and the trees of an open file."""

    def __init__(self, ranges: binary.Ranges):
        self.ranges = ranges
        head = ranges.read(0, 64)
        if len(head) < 64:
            raise ValueError("not a bigWig file")
        order = [o for o in "<>" if struct.unpack_from(o + "I", head)[0] == _MAGIC]
        if not order:
            raise ValueError("not a bigWig file")
        self.order = order[0]
        _, _, _, self.chrom_at, _, self.index_at, *_, buffer, _ = struct.unpack(self.order + _HEADER, head)
        self.packed = buffer > 0

    def _unpack(self, form: str, blob: bytes, at: int = 0) -> tuple:
        return struct.unpack_from(self.order + form, blob, at)

    def chroms(self) -> dict[int, tuple[str, int]]:
        """Name and length of each chromosome by number."""
        magic, _, key, _, _, _ = self._unpack("IIIIQQ", self.ranges.read(self.chrom_at, 32))
        if magic != _CHROM_MAGIC:
            raise ValueError("no chromosome tree")
        out, open_nodes = {}, [self.chrom_at + 32]
        while open_nodes:
            at = open_nodes.pop()
            leaf, _, n = self._unpack(_NODE, self.ranges.read(at, 4))
            body = self.ranges.read(at + 4, n * (key + 8))
            for i in range(n):
                own = body[i * (key + 8) : (i + 1) * (key + 8)]
                name, rest = own[:key], own[key:]
                if leaf:
                    number, size = self._unpack("II", rest)
                    out[number] = name.rstrip(b"\0").decode(), size
                else:
                    open_nodes += self._unpack("Q", rest)
        return out

    def root(self) -> int:
        if self._unpack("I", self.ranges.read(self.index_at, 4))[0] != _INDEX_MAGIC:
            raise ValueError("no block index")
        return self.index_at + 48

    def children(self, at: int) -> list[Node]:
        leaf, _, n = self._unpack(_NODE, self.ranges.read(at, 4))
        form = "IIIIQQ" if leaf else "IIIIQ"
        width = struct.calcsize(self.order + form)
        body = self.ranges.read(at + 4, n * width)
        rows = [self._unpack(form, body, i * width) for i in range(n)]
        return [Node((a, b), (c, d), where, more[0] if leaf else None) for a, b, c, d, where, *more in rows]


def decode(blob: bytes, packed: bool, order: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Chromosome number, starts, ends and values of a block."""
    data = zlib.decompress(blob) if packed else blob
    chrom, start, _, step, span, kind, _, n = struct.unpack_from(order + _SECTION, data)
    body = data[24:]
    if kind == 1:  # intervals
        rows = np.frombuffer(body, np.dtype([("s", order + "u4"), ("e", order + "u4"), ("v", order + "f4")]), n)
        return chrom, rows["s"], rows["e"], rows["v"]
    if kind == 2:  # starts of one span
        rows = np.frombuffer(body, np.dtype([("s", order + "u4"), ("v", order + "f4")]), n)
        return chrom, rows["s"], rows["s"] + np.uint32(span), rows["v"]
    if kind == 3:  # one span at even steps
        starts = np.uint32(start) + np.arange(n, dtype=np.uint32) * np.uint32(step)
        return chrom, starts, starts + np.uint32(span), np.frombuffer(body, order + "f4", n)
    raise ValueError(f"unknown kind of block: {kind}")


def _batch(found: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    names, starts, ends, values = zip(*found, strict=True)
    number = np.repeat(np.arange(len(names), dtype=np.int32), [len(s) for s in starts])
    name = pa.DictionaryArray.from_arrays(pa.array(number), pa.array(names)).cast(pa.string())
    column = lambda parts, kind: pa.array(np.concatenate([x.astype(kind) for x in parts]))
    return pa.record_batch([name, column(starts, np.int32), column(ends, np.int32), column(values, np.float64)], ["chrom", "start", "end", "value"])


def _batches(found: Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Blocks (chromosome, starts, ends, values) as batches; small ones, as of many short chromosomes, share one."""
    held, n = [], 0
    for block in found:
        held.append(block)
        n += len(block[1])
        if n >= _ITEMS:
            yield _batch(held)
            held, n = [], 0
    if held:
        yield _batch(held)


@dataclass
class _Part(InputPartition):
    """Subtrees, or blocks, of one file."""

    def __init__(self, uri: str, nodes: list[Node]):
        super().__init__(uri)
        self.uri, self.nodes = uri, nodes


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.index, self.tasks = options["path"], options.get("index", "false") == "true", int(options.get("tasks", "64"))
        self.sizes = options.get("sizes", "false") == "true"
        self.chroms: set[str] | None = None
        self.after, self.before = -1, 2**40  # a row ends behind ``after`` and starts in front of ``before``

    def pushFilters(self, filters):
        """Chromosomes and bounds of start and end prune the tree; Spark filters again by row."""
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column == "chrom" and isinstance(f, (EqualTo, In)):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.chroms = named if self.chroms is None else self.chroms & named
            elif column == "end" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.after = max(self.after, f.value - isinstance(f, GreaterThanOrEqual))
            elif column == "start" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.before = min(self.before, f.value + isinstance(f, LessThanOrEqual))
            yield f

    def _wanted(self, node: Node, chroms: dict[int, tuple[str, int]]) -> bool:
        (a, s), (b, e) = node.lo, node.hi
        if self.chroms is not None and not any(chroms[i][0] in self.chroms for i in range(a, b + 1) if i in chroms):
            return False
        return a != b or (e > self.after and s < self.before)

    def partitions(self):
        parts = []
        if self.sizes:
            return [_Part(uri, []) for uri, _ in binary.files(self.path, ".bw")] or [_Part("", [])]
        for uri, _ in binary.files(self.path, ".bw"):
            with binary.Ranges(uri) as r:
                f = BigWig(r)
                chroms, level = f.chroms(), [Node((0, 0), (2**32, 0), f.root(), None)]
                while level and len(level) < self.tasks and level[0].size is None:
                    level = [c for n in level for c in f.children(n.at) if self._wanted(c, chroms)]
            # blocks of some MB, or a share of the subtrees, for each task
            held, size = [], 0
            for node in level:
                held.append(node)
                size += node.size or 0
                if size >= _TASK_BYTES or (node.size is None and len(held) * self.tasks >= len(level)):
                    parts.append(_Part(uri, held))
                    held, size = [], 0
            parts += [_Part(uri, held)] if held else []
        return parts or [_Part("", [])]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        if not part.uri:
            return
        with binary.Ranges(part.uri) as r:
            f = BigWig(r)
            chroms = f.chroms()
            if self.sizes:
                yield pa.RecordBatch.from_pylist([{"chrom": c, "size": n} for c, n in chroms.values()], _SIZES)
            elif self.index:
                yield from self._blocks(part.uri, f, chroms, self._leaves(part, f, chroms))
            else:
                yield from _batches(self._values(f, chroms, self._leaves(part, f, chroms)))

    def _leaves(self, part: _Part, f: BigWig, chroms: dict[int, tuple[str, int]]) -> Iterator[Node]:
        todo = list(reversed(part.nodes))
        while todo:
            node = todo.pop()
            if node.size is None:
                todo += reversed([c for c in f.children(node.at) if self._wanted(c, chroms)])
            else:
                yield node

    def _blocks(self, uri: str, f: BigWig, chroms: dict[int, tuple[str, int]], leaves: Iterator[Node]) -> Iterator[pa.RecordBatch]:
        held = []
        for node in leaves:
            for number in range(node.lo[0], node.hi[0] + 1):
                start = node.lo[1] if number == node.lo[0] else 0
                end = node.hi[1] if number == node.hi[0] else chroms[number][1]
                held.append(dict(zip(_INDEX.names, (uri, chroms[number][0], start, end, node.at, node.size, f.packed, f.order == ">"), strict=True)))
            if len(held) >= _ITEMS:
                yield pa.RecordBatch.from_pylist(held, _INDEX)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, _INDEX)

    def _values(self, f: BigWig, chroms: dict[int, tuple[str, int]], leaves: Iterator[Node]) -> Iterator[tuple]:
        for node in leaves:
            number, *rows = decode(f.ranges.read(node.at, node.size), f.packed, f.order)
            if self.chroms is None or chroms[number][0] in self.chroms:
                yield chroms[number][0], *rows


_SIZES = pa.schema([("chrom", pa.string()), ("size", pa.int64())])
_INDEX = pa.schema([("file", pa.string()), ("chrom", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("offset", pa.int64()), ("bytes", pa.int64()), ("packed", pa.bool_()), ("swapped", pa.bool_())])


class BigWigSource(DataSource):
    """``spark.read.format("bigwig")``: a bigWig file or a folder of ``.bw`` files as (chrom, start, end, value), 0-based and half open.

    Options: ``index`` = true for the table of blocks in place of values, ``sizes`` = true for each file's chromosomes (chrom, size); ``tasks``, the least number of
    subtrees of a file to deal out.
    """

    @classmethod
    def name(cls) -> str:
        return "bigwig"

    def schema(self) -> str:
        if self.options.get("sizes", "false") == "true":
            return "chrom string, size long"
        return BLOCKS if self.options.get("index", "false") == "true" else VALUES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def _read(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(BigWigSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("bigwig").options(**options).load(path)


def bigwig(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end, value) of a file or a folder of ``.bw`` files; filters by chromosome, start and end prune blocks."""
    return _read(spark, path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The block index: (file, chrom, start, end, offset, bytes, packed, swapped), a row for each chromosome that a block touches."""
    return _read(spark, path, index="true")


def chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, size) as the files' headers have them; each file's list is read by a task."""
    for uri, _ in binary.files(path, ".bw"):
        with binary.Ranges(uri) as r:
            BigWig(r)  # what is no bigWig file is refused at once
    return _read(spark, path, sizes="true").groupBy("chrom").agg(F.max("size").alias("size"))


def touched(regions: DataFrame, index: DataFrame, bin_size: int = 1 << 17) -> DataFrame:
    """The distinct blocks of an index that overlap a region (chrom, start, end)."""
    dealt = lambda d: F.explode(F.sequence(F.floor(F.greatest(d["start"], F.lit(0)) / bin_size), F.floor((F.greatest(d["end"], d["start"] + 1) - 1) / bin_size)))
    r = regions.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), dealt(regions).alias("bin")).distinct()
    return index.withColumn("bin", dealt(index)).join(r, ["chrom", "bin"]).where("start < r_end and r_start < end").select("file", "offset", "bytes", "packed", "swapped").distinct()


def _decode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches(_decoded(batches))


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Chromosome, starts, ends and values of blocks that come sorted by file and offset; neighbours are read at once."""
    open_file, f, chroms = None, None, {}
    for batch in batches:
        rows = batch.to_pylist()
        i = 0
        while i < len(rows):
            first, j = rows[i], i + 1
            end = first["offset"] + first["bytes"]
            while j < len(rows) and rows[j]["file"] == first["file"] and rows[j]["offset"] - end <= _GAP and rows[j]["offset"] + rows[j]["bytes"] - first["offset"] <= 16 << 20:
                end = rows[j]["offset"] + rows[j]["bytes"]
                j += 1
            if open_file != first["file"]:
                f = BigWig(binary.Ranges(first["file"]))
                open_file, chroms = first["file"], f.chroms()
            blob = f.ranges.read(first["offset"], end - first["offset"])
            for row in rows[i:j]:
                at = row["offset"] - first["offset"]
                number, *found = decode(blob[at : at + row["bytes"]], f.packed, f.order)
                yield chroms[number][0], *found
            i = j


def values(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """(chrom, start, end, value) of the blocks that regions (chrom, start, end) touch; no other block is read."""
    found = touched(regions, blocks(spark, path))
    return found.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(_decode_blocks, VALUES)


def conservation(spark: SparkSession, regions: DataFrame, path: str | None, ident: list[str], flank: int = 2) -> DataFrame:
    """Mean value over each region (ident, chrom, start, end) widened by ``flank``: (ident, mean).

    0 without a file, on chromosomes the file does not have, where the widened region leaves its chromosome, and where nothing is known.
    """
    every = regions.select(*ident).distinct()
    if path is None:
        return every.withColumn("mean", F.lit(0.0))
    inside = regions.join(chrom_sizes(spark, path), "chrom").where((F.col("start") >= flank) & (F.col("end") + flank <= F.col("size"))).drop("size")
    known = values(spark, path, inside.select("chrom", (F.col("start") - flank).alias("start"), (F.col("end") + flank).alias("end")))
    return every.join(mean_value(inside, known, ident, flank), ident, "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))


def _tree(items: list[tuple], at: int, leaf: str, inner: str) -> bytes:
    """An R-tree's nodes, the root first: ``items`` are (lo, hi, offset, size)."""
    levels = [[items[i : i + _FANOUT] for i in range(0, len(items), _FANOUT)] or [[]]]
    span = lambda node: (min(x[0] for x in node), max(x[1] for x in node))
    while len(levels[0]) > 1:
        below = levels[0]
        levels.insert(0, [[(*span(n), i + k) for k, n in enumerate(below[i : i + _FANOUT])] for i in range(0, len(below), _FANOUT)])
    out = b""
    for depth, level in enumerate(levels):
        last = depth == len(levels) - 1
        size = sum(4 + len(n) * struct.calcsize(leaf if last else inner) for n in level)
        # where the next level's nodes begin
        starts, place = [], at + len(out) + size
        if not last:
            width = struct.calcsize(leaf if depth + 2 == len(levels) else inner)
            for n in levels[depth + 1]:
                starts.append(place)
                place += 4 + len(n) * width
        for n in level:
            out += struct.pack("<" + _NODE, last, 0, len(n))
            out += b"".join(struct.pack(leaf, *x[0], *x[1], *x[2:]) if last else struct.pack(inner, *x[0], *x[1], starts[x[2]]) for x in n)
    return out


def _chrom_tree(names: list[tuple[str, int]], at: int) -> bytes:
    """The tree of chromosomes (name, size), numbered by name, from its header at ``at`` on; a node's count has 16 bits, so many chromosomes make levels."""
    key = max(len(n.encode()) for n, _ in names)
    full = 4 + _FANOUT * (key + 8)
    dealt = lambda x: [x[i : i + _FANOUT] for i in range(0, len(x), _FANOUT)]
    levels = [dealt([(n.encode().ljust(key, b"\0"), struct.pack("<II", i, size)) for i, (n, size) in enumerate(names)])]
    while len(levels[0]) > 1:
        levels.insert(0, dealt([(node[0][0], i) for i, node in enumerate(levels[0])]))
    out, place = [struct.pack("<IIIIQQ", _CHROM_MAGIC, _FANOUT, key, 8, len(names), 0)], at + 32
    for depth, level in enumerate(levels):
        leaf = depth == len(levels) - 1
        place += sum(4 + len(n) * (key + 8) for n in level)  # where the next level begins, all of whose nodes but the last are full
        for n in level:
            out.append(struct.pack("<" + _NODE, leaf, 0, len(n)) + b"".join(k + (x if leaf else struct.pack("<Q", place + x * full)) for k, x in n))
    return b"".join(out)


def _file(sections: list[tuple[tuple, tuple, bytes]], names: list[tuple[str, int]], raw: int, items: int) -> bytes:
    """A whole file of compressed sections (lo, hi, blob) on the chromosomes ``names`` (name, size)."""
    tree = _chrom_tree(names, 64)
    data_at = 64 + len(tree)
    placed, at = [], data_at + 8
    for lo, hi, blob in sections:
        placed.append((lo, hi, at, len(blob)))
        at += len(blob)
    lo, hi = sections[0][0], max(s[1] for s in sections)
    index = struct.pack("<IIQIIIIQII", _INDEX_MAGIC, _FANOUT, len(sections), *lo, *hi, at, 1, 0) + _tree(placed, at + 48, "<IIIIQQ", "<IIIIQ")
    head = struct.pack("<" + _HEADER, _MAGIC, 4, 0, 64, data_at, at, 0, 0, 0, 0, raw, 0)
    return head + tree + struct.pack("<Q", len(sections)) + b"".join(b for *_, b in sections) + index


def write_bigwig(rows: DataFrame, sizes: DataFrame, path: str, file_bytes: int = 64 << 20) -> None:
    """Write (chrom, start, end, value) as a folder of ``.bw`` files, each a stretch of the genome of at most about ``file_bytes``.

    ``sizes`` (chrom, size) is a genome's list of chromosomes, joined to the rows; rows of others are left out.  A file lists the chromosomes it has values of.
    Values become 32-bit floats.
    """
    folder = path.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sections, names, held, n = [], {}, 0, 0

        def flush():
            if not sections:
                return None
            uri = f"{folder}/{uuid.uuid4().hex}.bw"
            binary.put(uri, _file(sections, list(names.items()), 24 + 12 * _ITEMS, n))
            return pa.RecordBatch.from_pylist([{"file": uri}], pa.schema([("file", pa.string())]))

        for batch in batches:
            chrom, start, end, value, size = (batch.column(i) for i in range(5))
            # rows come by name, so that chromosomes are numbered by it, as the tree wants them
            numbers = []
            for c, m in zip(chrom.to_pylist(), size.to_pylist(), strict=True):
                names.setdefault(c, m)
                numbers.append(len(names) - 1)
            chrom = np.array(numbers, np.int64)
            rows = np.empty(len(chrom), np.dtype([("s", "<u4"), ("e", "<u4"), ("v", "<f4")]))
            rows["s"], rows["e"], rows["v"] = start.to_numpy(), end.to_numpy(), value.to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(chrom)) + 1).tolist(), len(chrom)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for i in range(a, b, _ITEMS):
                    own, c = rows[i : min(i + _ITEMS, b)], int(chrom[i])
                    lo, hi = int(own["s"].min()), int(own["e"].max())
                    blob = zlib.compress(struct.pack("<" + _SECTION, c, lo, hi, 0, 0, 1, 0, len(own)) + own.tobytes(), 6)
                    sections.append(((c, lo), (c, hi), blob))
                    held, n = held + len(blob), n + len(own)
            if held >= file_bytes:
                yield flush()
                sections, names, held, n = [], {}, 0, 0
        done = flush()
        if done is not None:
            yield done

    listed = sizes.groupBy("chrom").agg(F.max("size").cast("long").alias("size"))
    dealt = rows.where("value is not null").select("chrom", F.col("start").cast("long"), F.col("end").cast("long"), F.col("value").cast("double")).join(listed, "chrom")
    written = dealt.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start", "end").mapInArrow(write, "file string")
    # the files of finished tasks alone belong to the folder
    keep = {r.file.rsplit("/", 1)[1] for r in written.collect()}
    system, at = binary.system_of(folder)
    system.create_dir(at, recursive=True)
    for uri, _ in binary.files(folder, ".bw"):
        name = uri.rsplit("/", 1)[1]
        if name not in keep:
            system.delete_file(f"{at}/{name}")
