"""BAM files: alignments in blocked gzip, read in parallel with or without an index, and by region through the binning index.

A file is cut at virtual offsets (block and place in it).  With a ``.bai`` beside it the cuts are record starts that the index knows; without one a task
looks for the first block behind its cut and for the first place there from which a chain of records follows, and where its own records end it
checks that the next task begins at that very record.
"""

from __future__ import annotations

import bisect
import json
import struct
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import binary
from .text import region_reads

# Fixed values of the format.
_BASES, _OPS = b"=ACMGRSVTWYHKDBN", b"MIDNSHP=X"
_FIXED = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("len", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("tlen", "<i4")])
_EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_SIZES = {b"A": 1, b"c": 1, b"C": 1, b"s": 2, b"S": 2, b"i": 4, b"I": 4, b"f": 4}
_NUMBERS = {b"c": "<b", b"C": "<B", b"s": "<h", b"S": "<H", b"i": "<i", b"I": "<I"}
_WINDOW, _META_BIN = 14, 37450
_BLOCK = 65280
_PAIRS = np.array([[_BASES[i >> 4], _BASES[i & 15]] for i in range(256)], np.uint8)
SCHEMA = "read string, flag int, tag string, start int, cigar string, seq string, qual string, score int, second int, others string"
_END = 1 << 62


class Blocks:
    """The blocks of an open file, read some MB at once."""

    def __init__(self, ranges: binary.Ranges, ahead: int = 4 << 20):
        self.ranges, self.ahead, self.at, self.held, self.count = ranges, ahead, 0, b"", 0

    def _bytes(self, at: int, n: int) -> bytes:
        if not self.at <= at <= at + n <= self.at + len(self.held):
            self.at, self.held = at, self.ranges.read(at, max(n, self.ahead))
        return self.held[at - self.at : at - self.at + n]

    def length(self, at: int) -> int | None:
        """Bytes of the block at an offset, None where none begins."""
        head = self._bytes(at, 18)
        if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
            return None
        extra = struct.unpack_from("<H", head, 10)[0]
        fields, i = self._bytes(at + 12, extra), 0
        while i + 4 <= len(fields):
            kind, n = fields[i : i + 2], struct.unpack_from("<H", fields, i + 2)[0]
            if kind == b"BC" and n == 2:
                return struct.unpack_from("<H", fields, i + 4)[0] + 1
            i += 4 + n
        return None

    def load(self, at: int) -> tuple[bytes, int]:
        """A block's data, and where the next one begins."""
        n = self.length(at)
        if n is None:
            raise ValueError(f"no block at {at}")
        block = self._bytes(at, n)
        extra = struct.unpack_from("<H", block, 10)[0]
        data = zlib.decompress(block[12 + extra : -8], -15)
        if zlib.crc32(data) != struct.unpack_from("<I", block, n - 8)[0]:
            raise ValueError(f"a damaged block at {at}")
        self.count += 1
        return data, at + n

    def full_from(self, at: int) -> int:
        """Where the first block with data begins, from a block on; the file's size where none does."""
        while at < self.ranges.size:
            n = self.length(at)
            if n is None or struct.unpack_from("<I", self._bytes(at, n), n - 4)[0]:
                return at
            at += n
        return at

    def first_from(self, at: int) -> int:
        """Where the first block at or behind an offset begins; the file's size where none does."""
        while at < self.ranges.size:
            window = self._bytes(at, min(1 << 17, self.ranges.size - at))
            i = window.find(b"\x1f\x8b\x08\x04")
            while i >= 0:
                n = self.length(at + i)
                # a block is followed by a block, or by the end
                if n is not None and (at + i + n == self.ranges.size or self.length(at + i + n) is not None):
                    return at + i
                i = window.find(b"\x1f\x8b\x08\x04", i + 1)
            at += max(1, len(window) - 3)
        return self.ranges.size


@dataclass
class Header:
    refs: list[tuple[str, int]]
    begin: int  # the first record's virtual offset


def header(blocks: Blocks) -> Header:
    data, at = blocks.load(0)
    starts = [(0, 0)]

    def need(n: int) -> None:
        nonlocal data, at
        while len(data) < n:
            more, after = blocks.load(at)
            starts.append((len(data), at))
            data, at = data + more, after

    if data[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    need(12)
    p = 8 + struct.unpack_from("<i", data, 4)[0]
    need(p + 4)
    n, refs = struct.unpack_from("<i", data, p)[0], []
    p += 4
    for _ in range(n):
        need(p + 4)
        size = struct.unpack_from("<i", data, p)[0]
        need(p + 8 + size)
        refs.append((data[p + 4 : p + 3 + size].decode(), struct.unpack_from("<i", data, p + 4 + size)[0]))
        p += 8 + size
    place, block = starts[bisect.bisect_right(starts, (p, _END)) - 1]
    return Header(refs, at << 16 if p == len(data) else block << 16 | p - place)


def _starts_record(data: bytes, at: int, refs: list[tuple[str, int]], chain: int = 5) -> bool:
    """Does a chain of whole records begin here?  What reaches beyond the data cannot speak against it."""
    for _ in range(chain):
        if at + 36 > len(data):
            return True
        size, ref, pos, name, _, _, ops, _, n, next_ref, next_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
        body = 32 + name + 4 * ops + (n + 1) // 2 + n
        if not (name >= 1 and n >= 0 and size >= body and -1 <= ref < len(refs) and -1 <= next_ref < len(refs) and pos >= -1 and next_pos >= -1):
            return False
        if (ref >= 0 and pos > refs[ref][1]) or (next_ref >= 0 and next_pos > refs[next_ref][1]):
            return False
        text = data[at + 36 : at + 36 + name]
        if len(text) == name and (text[-1] or not all(33 <= c <= 126 for c in text[:-1])):
            return False
        at += 4 + size
    return True


def first_record(blocks: Blocks, at: int, refs: list[tuple[str, int]]) -> int:
    """Virtual offset of the first record that begins in a block at or behind an offset."""
    at = blocks.first_from(at)
    data, starts = b"", []
    p = 0
    while at < blocks.ranges.size or p < len(data):
        # enough to see some records from each place on
        while at < blocks.ranges.size and len(data) < p + (1 << 18):
            more, after = blocks.load(at)
            starts.append((len(data), at))
            data, at = data + more, after
        if len(data) < 36 + p:
            break
        stop = len(data) if at >= blocks.ranges.size else len(data) - (1 << 17)
        n = max(0, min(stop, len(data) - 35) - p)
        field = lambda offset, kind: np.ndarray((n,), kind, data, p + offset, (1,))  # noqa: E731, B023
        likely = (field(0, "<i4") >= 34) & (field(4, "<i4") >= -1) & (field(4, "<i4") < len(refs)) & (field(8, "<i4") >= -1) & (field(24, "<i4") >= -1) & (field(24, "<i4") < len(refs)) & (field(28, "<i4") >= -1)
        for q in (np.flatnonzero(likely) + p).tolist():
            if _starts_record(data, q, refs):
                place, block = starts[bisect.bisect_right(starts, (q, _END)) - 1]
                return block << 16 | q - place
        p += max(n, 1)
    return blocks.ranges.size << 16


def records(blocks: Blocks, begin: int, end: int, batch: int = 4 << 20) -> Iterator[tuple[bytes, list[int], int]]:
    """Data and places of the records that begin at virtual offsets ``begin`` to ``end``; the third is where the first one not given begins.

    No block at or behind ``end`` is read but for the rest of a record that begins before it.
    """
    at, skip = begin >> 16, begin & 0xFFFF
    data, starts, torn = b"", [], False
    while True:
        parts, held, most = [data], len(data), len(data) + batch
        while at < blocks.ranges.size and held < most and (at << 16 < end or torn):
            more, after = blocks.load(at)
            starts.append((held - skip, at))
            parts.append(more[skip:])
            held, at, skip, torn = held + len(more) - skip, after, 0, False
        data = b"".join(parts)
        found, p, k, full = [], 0, 0, False
        while p + 4 <= len(data):
            while k + 1 < len(starts) and starts[k + 1][0] <= p:
                k += 1
            if starts[k][1] << 16 | p - starts[k][0] >= end:
                full = True
                break
            size = struct.unpack_from("<i", data, p)[0]
            if p + 4 + size > len(data):
                break
            found.append(p)
            p += 4 + size
        while k + 1 < len(starts) and starts[k + 1][0] <= p:
            k += 1
        last = full or (p == len(data) and at << 16 >= end) or at >= blocks.ranges.size
        if p == len(data):
            rest = blocks.full_from(at) << 16
        else:
            rest = starts[k][1] << 16 | p - starts[k][0]
        if found or last:
            yield data, found, rest
        if last:
            if not full and p < len(data):
                raise ValueError("the file ends inside a record")
            return
        torn = p < len(data)
        if not p:
            batch *= 2  # a record longer than the batch
        data, starts = data[p:], [(s - p, b) for s, b in starts[k:]]


def _take(values: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count)
    return values[np.repeat(begin - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]


def _strings(values: np.ndarray, count: np.ndarray, star: np.ndarray | None = None) -> pa.Array:
    """Strings that stand one after another; those of ``star`` are ``*``."""
    if star is not None and star.any():
        whole = np.empty(int(np.where(star, 1, count).sum()), np.uint8)
        count2 = np.where(star, 1, count)
        at = np.cumsum(count2) - count2
        whole[at[star]] = ord("*")
        mask = np.ones(len(whole), bool)
        mask[at[star]] = False
        whole[mask] = values
        values, count = whole, count2
    ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(count), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values, np.uint8)))


def _optional(data: bytes, at: int, end: int) -> tuple[int | None, int | None, str | None]:
    """AS, XS and XA of a record's optional fields."""
    got: dict[bytes, int | str] = {}
    while at + 3 <= end:
        name, kind = data[at : at + 2], data[at + 2 : at + 3]
        at += 3
        if kind in (b"Z", b"H"):
            stop = data.index(b"\0", at)
            if name in (b"XA",):
                got[name] = data[at:stop].decode()
            at = stop + 1
        elif kind == b"B":
            at += 5 + _SIZES[data[at : at + 1]] * struct.unpack_from("<i", data, at + 1)[0]
        else:
            if name in (b"AS", b"XS") and kind in _NUMBERS:
                got[name] = struct.unpack_from(_NUMBERS[kind], data, at)[0]
            at += _SIZES[kind]
    return got.get(b"AS"), got.get(b"XS"), got.get(b"XA")


def decode(data: bytes, places: list[int], refs: list[tuple[str, int]]) -> pa.RecordBatch:
    """Records as rows of :data:`SCHEMA`."""
    raw, at = np.frombuffer(data, np.uint8), np.array(places, np.int64)
    f = np.ascontiguousarray(raw[at[:, None] + np.arange(36)]).view(_FIXED).ravel() if len(at) else np.zeros(0, _FIXED)
    name, ops, n = f["name"].astype(np.int64), f["ops"].astype(np.int64), f["len"].astype(np.int64)
    cigar_at = at + 36 + name
    seq_at = cigar_at + 4 * ops
    half = (n + 1) // 2
    # operations by their distinct values
    codes = _take(raw, cigar_at, 4 * ops).view("<u4")
    known, which = np.unique(codes, return_inverse=True)
    texts = [b"%d%c" % (c >> 4, _OPS[c & 15]) for c in known.tolist()]
    size = np.array([len(t) for t in texts], np.int64)
    flat = _take(np.frombuffer(b"".join(texts), np.uint8), (np.cumsum(size) - size)[which], size[which])
    cigar = np.diff(np.concatenate([[0], np.cumsum(size[which])])[np.concatenate([[0], np.cumsum(ops)])])
    bases = _PAIRS[_take(raw, seq_at, half)].ravel()
    seq = _take(bases, 2 * (np.cumsum(half) - half), n)
    qual_at = seq_at + half
    unknown = (n == 0) | (raw[np.minimum(qual_at, len(raw) - 1)] == 0xFF) if len(at) else np.zeros(0, bool)
    qual = _take(raw, qual_at, np.where(unknown, 0, n)) + np.uint8(33)
    score, second, others = zip(*(_optional(data, a, b) for a, b in zip((qual_at + n).tolist(), (at + 4 + f["size"]).tolist(), strict=True)), strict=True) if len(at) else ((), (), ())
    names = pa.array([r for r, _ in refs] + ["*"], pa.string())
    tag = names.take(pa.array(np.where(f["ref"] < 0, len(refs), f["ref"]).astype(np.int64)))
    columns = [
        _strings(_take(raw, at + 36, name - 1), name - 1),
        pa.array(f["flag"].astype(np.int32)),
        tag,
        pa.array(f["pos"].astype(np.int32)),
        _strings(flat, cigar, ops == 0),
        _strings(seq, n, n == 0),
        _strings(qual, np.where(unknown, 0, n), unknown),
        pa.array(score, pa.int32()),
        pa.array(second, pa.int32()),
        pa.array(others, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCHEMA.split(", ")])


class Index:
    """A ``.bai`` file: chunks of virtual offsets by reference and bin, and the least offset of each window of 16 kb."""

    def __init__(self, blob: bytes):
        if blob[:4] != b"BAI\1":
            raise ValueError("not a BAM index")
        p, self.bins, self.linear = 8, [], []
        for _ in range(struct.unpack_from("<i", blob, 4)[0]):
            bins: dict[int, list[tuple[int, int]]] = {}
            (n,) = struct.unpack_from("<i", blob, p)
            p += 4
            for _ in range(n):
                number, chunks = struct.unpack_from("<Ii", blob, p)
                flat = struct.unpack_from(f"<{2 * chunks}Q", blob, p + 8)
                p += 8 + 16 * chunks
                if number != _META_BIN:
                    bins[number] = list(zip(flat[::2], flat[1::2], strict=True))
            (n,) = struct.unpack_from("<i", blob, p)
            self.linear.append(struct.unpack_from(f"<{n}Q", blob, p + 4))
            self.bins.append(bins)
            p += 4 + 8 * n

    def chunks(self, ref: int, start: int, end: int) -> list[tuple[int, int]]:
        """Stretches of virtual offsets that may hold records over a base of start:end."""
        line = self.linear[ref]
        least = line[min(start >> _WINDOW, len(line) - 1)] if line else 0
        return [(max(b, least), e) for number in bins_of(start, end) for b, e in self.bins[ref].get(number, []) if e > least]

    def places(self) -> list[int]:
        """Known starts of records."""
        return sorted({b for bins in self.bins for chunks in bins.values() for b, _ in chunks} | {x for line in self.linear for x in line if x})


def bins_of(start: int, end: int) -> Iterator[int]:
    """Numbers of the bins that overlap start:end, by the format's five levels of eightfold width."""
    yield 0
    for level in range(1, 6):
        first, shift = ((1 << 3 * level) - 1) // 7, 29 - 3 * level
        yield from range(first + (start >> shift), first + (max(end - 1, start) >> shift) + 1)


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds start:end."""
    for level in range(5, 0, -1):
        shift = 29 - 3 * level
        if start >> shift == end - 1 >> shift:
            return ((1 << 3 * level) - 1) // 7 + (start >> shift)
    return 0


def _index(uri: str) -> Index | None:
    for name in (uri + ".bai", uri.removesuffix(".bam") + ".bai"):
        try:
            with binary.Ranges(name) as r:
                return Index(r.read(0, r.size))
        except FileNotFoundError:
            continue
    return None


@dataclass
class _Part(InputPartition):
    """Stretches of virtual offsets of a file; ``sure`` tells that they begin with a record.  No record at or behind ``stop`` (reference, place) is wanted."""

    def __init__(self, uri: str, chunks: list[tuple[int, int]], sure: bool, stop: tuple[int, int] | None = None):
        super().__init__(uri)
        self.uri, self.chunks, self.sure, self.stop = uri, chunks, sure, stop


def _merged(chunks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Chunks that meet in a block as one."""
    out: list[tuple[int, int]] = []
    for b, e in sorted(chunks):
        if out and b >> 16 <= out[-1][1] >> 16:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((b, e))
    return out


def _wanted(blocks: Blocks, part: _Part) -> Iterator[tuple[bytes, list[int]]]:
    """Data and places of the records of a partition's chunks, up to its stop: files with an index are sorted by place."""
    for begin, end in part.chunks:
        for data, places, _ in records(blocks, begin, end, 1 << 18):
            if part.stop is not None:
                stop, number = part.stop, len(places)
                past = lambda p: (lambda ref, pos: (ref if ref >= 0 else 1 << 31, pos) >= stop)(*struct.unpack_from("<ii", data, p + 4))  # noqa: E731, B023
                places = places[: bisect.bisect_left(places, True, key=past)]
                yield data, places
                if len(places) < number:
                    return
            else:
                yield data, places


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.split = options["path"], int(options.get("splitbytes", str(32 << 20)))
        self.regions = json.loads(options["regions"]) if "regions" in options else None

    def _of_regions(self, uri: str, index: Index) -> list[_Part]:
        with binary.Ranges(uri) as r:
            number = {name: i for i, (name, _) in enumerate(header(Blocks(r, 1 << 16)).refs)}
        named = [(number[chrom], max(0, start), end) for chrom, start, end in self.regions if chrom in number]
        stop, parts, held = max(((ref, end) for ref, _, end in named), default=None), [], []
        for chunk in _merged([c for x in named for c in index.chunks(*x)]):
            held.append(chunk)
            if (chunk[1] >> 16) - (held[0][0] >> 16) >= self.split:
                parts.append(_Part(uri, held, True, stop))
                held = []
        return parts + ([_Part(uri, held, True, stop)] if held else [])

    def partitions(self):
        parts = []
        for uri, size in binary.files(self.path, ".bam"):
            index = _index(uri)
            if self.regions is not None and index is not None:
                parts += self._of_regions(uri, index)
                continue
            cuts = [c << 16 for c in range(self.split, size, self.split)]
            if index is not None:
                known = index.places()
                cuts = sorted({known[i] for c in cuts for i in [bisect.bisect_left(known, c)] if i < len(known)})
            parts += [_Part(uri, [(b, e)], index is not None) for b, e in zip([0, *cuts], [*cuts, size << 16], strict=True)]
        return parts or [_Part("", [], True)]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        if not part.uri:
            return
        with binary.Ranges(part.uri) as r:
            blocks = Blocks(r)
            head = header(blocks)
            if part.stop is not None:
                for data, places in _wanted(blocks, part):
                    yield decode(data, places, head.refs)
                return
            begin, end = part.chunks[0]
            begin = head.begin if not begin else begin if part.sure else first_record(blocks, begin >> 16, head.refs)
            if begin >= end:
                return
            rest = begin
            for data, places, rest in records(blocks, begin, end):
                for i in range(0, len(places), 10_000):
                    yield decode(data, places[i : i + 10_000], head.refs)
            if not part.sure and end >> 16 < r.size and first_record(blocks, end >> 16, head.refs) != rest:
                raise ValueError(f"records of {part.uri} cannot be told apart at {end >> 16}: index the file")


class BamSource(DataSource):
    """``spark.read.format("bam")``: a BAM file or a folder of ``.bam`` files as the rows that the SAM reader gives.

    Options: ``splitBytes``, bytes of a file for each task; ``regions``, a JSON list of [chromosome, start, end] (0-based, half open): files with an index give only
    the blocks that may hold their alignments, rows outside the regions among them.
    """

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def bam(spark: SparkSession, path: str, split_bytes: int = 32 << 20) -> DataFrame:
    """All alignments: read, flag, tag, start, cigar, seq, qual, score (AS), second (XS), others (XA); a field that the file leaves open is ``*`` or null."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("splitBytes", split_bytes).load(path)


def bam_region(spark: SparkSession, path: str, chrom: str, start: int, end: int) -> DataFrame:
    """Mapped alignments that cover a base of ``start:end`` (0-based) of a chromosome; an index lets it read few blocks."""
    spark.dataSource.register(BamSource)
    found = spark.read.format("bam").option("regions", json.dumps([[chrom, start, end]])).load(path)
    return region_reads(found, chrom, start, end)


@lru_cache(1 << 16)
def _operations(cigar: str | None) -> tuple[bytes, int, int]:
    """A CIGAR's operations as a record has them, their number and the bases of the reference that they span; reads share few CIGARs."""
    ops, n = [], 0
    for c in cigar.encode() if cigar not in (None, "*") else b"":
        if 48 <= c <= 57:
            n = n * 10 + c - 48
        else:
            ops.append(n << 4 | _OPS.index(c))
            n = 0
    return struct.pack(f"<{len(ops)}I", *ops), len(ops), max(1, sum(o >> 4 for o in ops if o & 15 in (0, 2, 3, 7, 8)))


def _record(row: dict, refs: dict[str, int]) -> tuple[bytes, int, int, int]:
    """A record's bytes, its reference, start and end."""
    ops, count, span = _operations(row["cigar"])
    ref, pos = refs.get(row["tag"], -1), row["start"] if row["start"] is not None else -1
    end = pos + span
    name = (row["read"] or "*").encode() + b"\0"
    seq = b"" if row["seq"] in (None, "*") else row["seq"].upper().encode()
    codes = [max(0, _BASES.find(c)) if c in _BASES else 15 for c in seq] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    qual = bytes(c - 33 for c in row["qual"].encode()) if row["qual"] not in (None, "*") and len(row["qual"]) == len(seq) else b"\xff" * len(seq)
    tags = b"".join(key + b"i" + struct.pack("<i", row[c]) for key, c in ((b"AS", "score"), (b"XS", "second")) if row[c] is not None)
    tags += b"XAZ" + row["others"].encode() + b"\0" if row["others"] is not None else b""
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), 255, bin_of(max(pos, 0), max(end, 1)), count, row["flag"], len(seq), -1, -1, 0)
    body += name + ops + packed + qual + tags
    return struct.pack("<i", len(body)) + body, ref, pos, end


class _Writer:
    """One file and its index in the making."""

    def __init__(self, refs: list[tuple[str, int]]):
        text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in refs)
        self.out, self.held, self.size, self.rows = [], bytearray(), 0, 0
        self.bins, self.linear = [defaultdict(list) for _ in refs], [{} for _ in refs]
        self._push(b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(refs)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", s) for n, s in refs))
        self._flush(0)

    def _push(self, data: bytes) -> None:
        self.held += data
        self._flush(_BLOCK)

    def _flush(self, least: int) -> None:
        while len(self.held) > least:
            part = bytes(self.held[:_BLOCK])
            del self.held[:_BLOCK]
            press = zlib.compressobj(6, zlib.DEFLATED, -15)
            body = press.compress(part) + press.flush()
            block = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
            self.out.append(block)
            self.size += len(block)

    def add(self, record: bytes, ref: int, pos: int, end: int) -> None:
        begin = self.size << 16 | len(self.held)
        self._push(record)
        self.rows += 1
        if ref >= 0:
            stop = self.size << 16 | len(self.held)
            chunks = self.bins[ref][bin_of(pos, end)]
            if chunks and chunks[-1][1] == begin:
                chunks[-1] = chunks[-1][0], stop
            else:
                chunks.append((begin, stop))
            for w in range(pos >> _WINDOW, (end - 1 >> _WINDOW) + 1):
                self.linear[ref].setdefault(w, begin)

    def finish(self, uri: str) -> None:
        self._flush(0)
        out = b"BAI\1" + struct.pack("<i", len(self.bins))
        for bins, linear in zip(self.bins, self.linear, strict=True):
            out += struct.pack("<i", len(bins)) + b"".join(struct.pack("<Ii", n, len(c)) + b"".join(struct.pack("<QQ", *x) for x in c) for n, c in sorted(bins.items()))
            windows = range(max(linear, default=-1) + 1)
            least, line = 0, []
            for w in windows:
                least = linear.get(w, least)
                line.append(least)
            out += struct.pack("<i", len(line)) + struct.pack(f"<{len(line)}Q", *line)
        binary.put(uri + ".bai", out)
        binary.put(uri, b"".join(self.out) + _EOF)


def write_bam(rows: DataFrame, sizes: DataFrame, path: str, file_bytes: int = 64 << 20) -> None:
    """Write alignments (the columns of :func:`bam`) as a folder of ``.bam`` files sorted by place, each with its index, of at most about ``file_bytes``.

    ``sizes`` (chrom, size) is a genome's list of chromosomes and comes to the driver.  Rows on none of them are written as unmapped, behind the others.
    """
    listed = sorted(map(tuple, sizes.select("chrom", "size").collect()))
    refs = {name: i for i, (name, _) in enumerate(listed)}
    folder = path.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None

        def done() -> pa.RecordBatch:
            uri = f"{folder}/{uuid.uuid4().hex}.bam"
            file.finish(uri)
            return pa.RecordBatch.from_pylist([{"file": uri}])

        for batch in batches:
            for row in batch.to_pylist():
                file = file or _Writer(listed)
                file.add(*_record(row, refs))
                if file.size >= file_bytes:
                    yield done()
                    file = None
        if file is not None:
            yield done()

    order = F.when(F.col("tag").isin(list(refs)), F.col("tag")) if refs else F.lit(None).cast("string")
    dealt = rows.select(*(x.split()[0] for x in SCHEMA.split(", ")), order.alias("__ref"))
    keys = [F.col("__ref").asc_nulls_last(), F.col("start")]
    written = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(write, "file string")
    keep = {r.file.rsplit("/", 1)[1] for r in written.collect()}
    system, at = binary.system_of(folder)
    system.create_dir(at, recursive=True)
    for ending in (".bam", ".bai"):
        for uri, _ in binary.files(folder, ending):
            name = uri.rsplit("/", 1)[1]
            if name.removesuffix(".bai") not in keep:
                system.delete_file(f"{at}/{name}")


def read_pairs(alignments: DataFrame) -> DataFrame:
    """Sequenced reads of alignments: (id, mate, seq, qual), mate 1 and 2 of pairs, 0 of what was sequenced singly.

    Each read comes once, from its primary record (neither secondary nor supplementary), as it was sequenced: those on the reverse strand are turned
    back.  Of several primary records of a mate the first by flag, chromosome and place counts.  Reads without sequence are left out.
    """
    bit = lambda n: F.col("flag").bitwiseAND(n) != 0
    d = alignments.where(~bit(0x100) & ~bit(0x800) & F.col("seq").isNotNull() & (F.col("seq") != "*"))
    mate = F.when(~bit(0x1) | (bit(0x40) == bit(0x80)), 0).when(bit(0x40), 1).otherwise(2)
    seq = F.when(bit(0x10), F.reverse(F.translate(F.upper("seq"), "ACGTMRYKVBHDWSN", "TGCAKYRMBVDHWSN"))).otherwise(F.upper("seq"))
    qual = F.when(bit(0x10), F.reverse("qual")).otherwise(F.col("qual"))
    first = F.min(F.struct("flag", "tag", "start", "seq", "qual")).alias("r")
    d = d.select(F.col("read").alias("id"), mate.alias("mate"), "flag", "tag", "start", seq.alias("seq"), qual.alias("qual"))
    return d.groupBy("id", "mate").agg(first).select("id", "mate", "r.seq", "r.qual")


def paired(reads: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First mates, second mates and singles (id, seq, qual) of :func:`read_pairs`; a mate whose partner is missing is a single."""
    both = reads.withColumn("both", F.sum(F.when(F.col("mate") > 0, 1).otherwise(0)).over(Window.partitionBy("id")) == 2)
    pick = lambda condition: both.where(condition).select("id", "seq", "qual")
    return pick("both and mate = 1"), pick("both and mate = 2"), pick("not both or mate = 0")
