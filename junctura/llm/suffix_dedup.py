"""Exact removal of long repeated byte strings: a difference-cover, blockwise suffix construction.

A suffix array answers "does the string of ``length`` bytes that starts here also start earlier?".  Only the first ``length``
bytes of a suffix matter, so suffixes are ordered to that depth, in three passes over the chunks of :mod:`chunks`:

1. *Corpus-wide cover samples.*  A difference cover D of period v holds, for any two positions i and j, an offset d < v with i+d and
   j+d both in the sample.  Of a sample suffix only one thing is asked here, whether another has its first length-v+1 bytes too; 40-bit
   fingerprints answer that, as a false "yes" only sends a suffix on.  A suffix whose next v samples are all unshared is alone and is never moved.
2. *Buckets.*  The others, long ties all, are dealt into buckets by the least mixed 8-byte string among their bytes, which equal suffixes
   share.  Neighbouring suffixes mostly share it, so a run of them travels as one string of bytes.  One bucket at a time is sorted
   (:func:`first_equal`): by first and last bytes, and what ties there by the ranks of a second cover's samples, which are built from the
   bucket's bytes by doubling.  Ranks and bytes alone decide what is equal; no fingerprint does.  The answer is one bit for each suffix.
   A bucket's bytes are measured before it is sorted: one beyond its bound, whose 8-byte string is common, is dealt anew by the least of the other strings among a
   suffix's bytes, which equal suffixes share as well (:func:`_next_runs`), into as many parts as its bytes need.
3. *Removal.*  Each chunk lays its bits over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import chunks, packing, rolling
from .store import Scratch

#: Difference covers by period.  Fixed values: perfect difference sets.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}
PIECE = 2 << 20
_SHORT = np.uint64(24)
_GRAM = 8
_SALT = np.uint64(0x5851F42D4C957F2D)
_RUNS = "__chunk int, texts binary, sizes binary, ords binary, ids binary, raw long"
_SENT = f"bucket int, {_RUNS}"
_NEXT = np.uint64(0xD6E8FEB86659FD93)
_ANSWER = "__chunk int, piece int, bucket int, bits binary"


def cover_period(length: int) -> int:
    """The largest period that leaves sample ranks at least two fifths of ``length`` deep."""
    return max(v for v in COVERS if v == 1 or v <= 0.6 * length)


class _Piece:
    """A stretch of a chunk: the windows that start in lo..hi, with the bytes they reach."""

    def __init__(self, chunk: chunks.Chunk, lo: int, hi: int, length: int):
        self.lo, self.length, self.v = lo, length, cover_period(length)
        stop = min(hi + length - 1, len(chunk.data))
        self.sums = rolling.prefixes(chunk.data[lo:stop])
        a, b = np.searchsorted(chunk.end, [lo, stop - 1], "right")
        docs = np.arange(a, b + 1, dtype=np.int32)
        ends = chunk.end[a : b + 1]
        here = np.diff(np.concatenate([[lo], np.minimum(ends, stop)]))
        self.doc = np.repeat(docs, here)
        self.left = np.repeat(np.minimum(ends - lo, 1 << 30).astype(np.int32), here) - np.arange(stop - lo, dtype=np.int32)
        self.starts = hi - lo

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the cover's suffixes and their short keys."""
        depth = self.length - self.v + 1
        n = len(self.left)
        at = np.concatenate([np.arange(r, n, self.v) for r in COVERS[self.v]]) if n else np.zeros(0, np.int64)
        at = at[self.left[at] >= depth]
        at = at[at + depth <= n]
        return at, rolling.windows(self.sums, depth, at) >> _SHORT

    def tied(self, at: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Starts of whole windows that see a shared sample rank."""
        near = _reached(at[shared], len(self.left), self.v - 1, 0)
        return np.flatnonzero(near[: self.starts] & (self.left[: self.starts] >= self.length))


def _pieces(chunk: chunks.Chunk, length: int) -> Iterator[tuple[int, _Piece]]:
    for i, lo in enumerate(range(0, len(chunk.data), PIECE)):
        yield i, _Piece(chunk, lo, min(lo + PIECE, len(chunk.data)), length)


def _reached(at: np.ndarray, n: int, before: int, after: int) -> np.ndarray:
    """Places of 0..n with a mark of ``at`` in what is ``before`` places ahead to ``after`` places behind."""
    marks = np.zeros(n + before + after + 1, np.int32)
    marks[at + after + 1] = 1
    np.cumsum(marks, out=marks)
    return marks[before + after + 1 :] != marks[:n]


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts ``keys``, and where each group of equal keys begins in it."""
    order = np.argsort(keys)
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def _cuts(keys: np.ndarray, bits: int, width: int) -> np.ndarray:
    """Where each of 2**bits buckets begins in sorted keys of ``width`` bits."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(width - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _by_piece(answers: pa.Table) -> dict[int, np.ndarray]:
    """Answers of each piece, its buckets in order."""
    got: dict[int, list[tuple[int, bytes]]] = {}
    for p, b, bits in zip(answers["piece"].to_pylist(), answers["bucket"].to_pylist(), answers["bits"].to_pylist(), strict=True):
        got.setdefault(p, []).append((b, bits))
    return {p: np.concatenate([packing.unpack_flags(x) for _, x in sorted(v)]) for p, v in got.items()}


def _send_samples(ident: str, text: str, length: int, bits: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for i, piece in _pieces(chunks.load(table, ident, text), length):
            keys = np.unique(piece.samples()[1])
            cuts = _cuts(keys, bits, 40)
            out += [(b, key[0].as_py(), i, packing.pack_sorted(keys[cuts[b] : cuts[b + 1]])) for b in np.flatnonzero(np.diff(cuts))]
        b, k, p, packed = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"bucket": pa.array(b, pa.int32()), chunks.KEY: pa.array(k, pa.int32()), "piece": pa.array(p, pa.int32()), "keys": chunks.binary(list(packed))})

    return send


def _shared_ranks(key: tuple, table: pa.Table) -> pa.Table:
    """Which keys of a bucket more than one piece has."""
    parts = [packing.unpack_sorted(x) for x in table["keys"].to_pylist()]
    keys = np.concatenate(parts)
    order, begin = _grouped(keys)
    shared = np.zeros(len(keys), bool)
    shared[order] = np.repeat(np.diff(np.append(begin, len(keys))) > 1, np.diff(np.append(begin, len(keys))))
    ends = np.cumsum([len(x) for x in parts])
    bits = [packing.pack_flags(shared[e - len(x) : e]) for x, e in zip(parts, ends, strict=True)]
    return pa.table({chunks.KEY: table[chunks.KEY], "piece": table["piece"], "bucket": table["bucket"], "bits": chunks.binary(bits)})


def _piece_ties(piece: _Piece, answer: np.ndarray | None) -> np.ndarray:
    at, short = piece.samples()
    if not len(at):
        return at
    _, inverse, times = np.unique(short, return_inverse=True, return_counts=True)
    return piece.tied(at, ((times > 1) | answer)[inverse])


def _eight(data: np.ndarray, kind: str = ">u8") -> np.ndarray:
    """The 8 bytes from each place on as a number, zeros behind the end; big-endian numbers are in byte order."""
    return np.ndarray(len(data) + 1, kind, np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


def _least(values: np.ndarray, k: int) -> np.ndarray:
    """The least of ``k`` values from each place on."""
    n = len(values) - k + 1
    if n < 1:
        return values[:0]
    rows = np.full((-(-len(values) // k), k), np.iinfo(values.dtype).max, values.dtype)
    rows.reshape(-1)[: len(values)] = values
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[k - 1 : k - 1 + n])


@dataclass
class _Runs:
    """Runs of neighbouring tied suffixes of a chunk with one bucket: where they start in the chunk, how many they are, and their bucket."""

    start: np.ndarray
    count: np.ndarray
    bucket: np.ndarray


def _runs(chunk: chunks.Chunk, length: int, shared: dict[int, np.ndarray], bits: int) -> _Runs:
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    gram = min(_GRAM, length)
    for i, piece in _pieces(chunk, length):
        at = _piece_ties(piece, shared.get(i))
        if not len(at):
            continue
        grams = _eight(chunk.data[piece.lo : piece.lo + len(piece.left)], "<u8")[: len(piece.left) - gram + 1]
        least = _least(rolling.mix(grams & np.uint64((1 << 8 * gram) - 1)), length - gram + 1)[at]
        begin = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1])]))
        bucket = rolling.mix(least[begin] ^ _SALT) >> np.uint64(64 - bits) if bits else np.zeros(len(begin), np.uint64)
        found.append((at[begin] + piece.lo, np.diff(np.append(begin, len(at))), bucket))
    start, count, bucket = (np.concatenate(x) for x in zip(*found, strict=True))
    return _Runs(start, count, bucket.astype(np.int64))


def _texts(chunk: chunks.Chunk, runs: _Runs, length: int) -> Iterator[tuple[int, bytes, bool]]:
    """Each run's place among the runs, its bytes, and whether the chunk has had a run of these bytes; runs of one bucket stand together, in order."""
    data, had = chunk.data, set()
    for j in np.argsort(runs.bucket, kind="stable").tolist():
        text = data[runs.start[j] : runs.start[j] + runs.count[j] + length - 1].tobytes()
        yield j, text, text in had
        had.add(text)


def _packed(own: list[tuple[bytes, int]], doc: np.ndarray, ids: np.ndarray) -> dict[str, bytes | int]:
    """Runs of bytes, each with its place in ``doc``, as a row: the bytes, their sizes, and the document of each among the distinct ones."""
    docs_here, ords = np.unique(doc[[j for _, j in own]], return_inverse=True)
    joined = b"".join(x for x, _ in own)
    return {
        "texts": zstandard.compress(joined, 1),
        "sizes": packing.pack_ints(np.array([len(x) for x, _ in own])),
        "ords": packing.pack_ints(ords),
        "ids": ids[docs_here].astype(np.int64).tobytes(),
        "raw": len(joined),
    }


def _unpacked(row: dict) -> tuple[list[bytes], np.ndarray]:
    """A row's runs and the id of each one's document."""
    blob = zstandard.decompress(row["texts"])
    ends = np.cumsum(packing.unpack_ints(row["sizes"]).astype(np.int64))
    texts = [blob[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    return texts, np.frombuffer(row["ids"], np.int64)[packing.unpack_ints(row["ords"]).astype(np.int64)]


def _sent(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def _send_runs(ident: str, text: str, length: int, bits: int, block: int, blocks: int):
    def send(key: tuple, docs: pa.Table, ranks: pa.Table) -> pa.Table:
        chunk = chunks.load(docs, ident, text)
        runs = _runs(chunk, length, _by_piece(ranks), bits)
        mine = (runs.bucket >= (block << bits) // blocks) & (runs.bucket < ((block + 1) << bits) // blocks)
        runs = _Runs(runs.start[mine], runs.count[mine], runs.bucket[mine])
        doc = np.searchsorted(chunk.end, runs.start, "right")
        parts: dict[int, list[tuple[bytes, int]]] = {}
        for j, run, had in _texts(chunk, runs, length):
            if not had:
                parts.setdefault(int(runs.bucket[j]), []).append((run, j))
        return _sent([{"bucket": b, chunks.KEY: key[0].as_py()} | _packed(own, doc, chunk.ids) for b, own in parts.items()], _SENT_ARROW)

    return send


_RUNS_ARROW = [(chunks.KEY, pa.int32()), *((c, pa.binary()) for c in ("texts", "sizes", "ords", "ids")), ("raw", pa.int64())]
_SENT_ARROW = pa.schema([("bucket", pa.int32()), *_RUNS_ARROW])
_SPLIT_ARROW = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), *_RUNS_ARROW])


def _next_runs(run: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a run's suffixes change the least of their strings of 8 bytes but for the run's own least one; how many follow, and that string's mixed value."""
    gram = min(_GRAM, length)
    k, n = length - gram + 1, len(run) - length + 1
    values = rolling.mix(_eight(run, "<u8")[: len(run) - gram + 1] & np.uint64((1 << 8 * gram) - 1))
    other = values.copy()
    other[values == values.min()] = np.iinfo(np.uint64).max
    least = _least(other, k)
    begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return begin, np.diff(np.append(begin, n)), least[begin]


def _parts(row: dict, length: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a row of a heavy bucket: its runs, and for each of their stretches the run, its start and count, and its part."""
    texts, _ = _unpacked(row)
    found = [_next_runs(np.frombuffer(t, np.uint8), length) for t in texts]
    of = np.repeat(np.arange(len(texts)), [len(b) for b, _, _ in found])
    start, count, value = (np.concatenate(x) for x in zip(*found, strict=True))
    part = rolling.mix(value ^ _NEXT) % np.uint64(row["parts"])
    return texts, of, start, count, part.astype(np.int64)


def _split_heavy(length: int):
    def split(key: tuple, table: pa.Table) -> pa.Table:
        """A chunk's row of a heavy bucket dealt by part; a stretch goes with the bytes that it reaches."""
        (row,) = table.to_pylist()
        texts, of, start, count, part = _parts(row, length)
        ids = _unpacked(row)[1]
        by: dict[int, list[tuple[bytes, int]]] = {}
        for j in np.argsort(part, kind="stable").tolist():
            a = int(start[j])
            by.setdefault(int(part[j]), []).append((texts[of[j]][a : a + int(count[j]) + length - 1], int(of[j])))
        every = np.arange(len(texts))
        return _sent([{"bucket": row["bucket"], "part": p, chunks.KEY: row[chunks.KEY]} | _packed(own, every, ids) for p, own in by.items()], _SPLIT_ARROW)

    return split


def _joined_parts(length: int):
    def join(key: tuple, runs: pa.Table, answers: pa.Table) -> pa.Table:
        """The answers of a heavy bucket's parts to a chunk, in the order of the chunk's suffixes."""
        (row,) = runs.to_pylist()
        texts, of, start, count, part = _parts(row, length)
        size = np.array([len(t) - length + 1 for t in texts])
        base = (np.cumsum(size) - size)[of] + start
        later = np.zeros(int(size.sum()), bool)
        got = {p: packing.unpack_flags(b) for p, b in zip(answers["piece"].to_pylist(), answers["bits"].to_pylist(), strict=True)}
        for p, bits in got.items():
            mine = np.flatnonzero(part == p)
            later[np.repeat(base[mine] - np.cumsum(count[mine]) + count[mine], count[mine]) + np.arange(count[mine].sum())] = bits
        return pa.table({chunks.KEY: runs[chunks.KEY], "piece": pa.array([-1], pa.int32()), "bucket": runs["bucket"], "bits": chunks.binary([packing.pack_flags(later)])})

    return join


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones."""
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


def first_equal(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For each suffix of ``text`` that starts at one of the places ``at``, the number of the first of them with the same ``length`` bytes.

    Suffixes are sorted by their first 8 bytes and their last 8 or 16; ties are resolved by ranks of the samples of the cover {0, 1, 3} modulo 7 to a depth that
    spans the middle.  The ranks come from the bytes themselves: 8 bytes are a number, and the ranks of two overlapping stretches give that of both.
    """
    if len(text) >= 1 << 30:
        raise ValueError("a bucket of a gigabyte: ranks would not fit their bits")
    eight = _eight(np.concatenate([text, np.zeros(length + 8, np.uint8)]))
    n, high = len(text), np.uint64(32)
    if length <= 8:
        name, offsets = _ranks(eight[at].astype(np.uint64) >> np.uint64(8 * (8 - length))), None
    else:
        name = _ranks(_ranks(eight[at].astype(np.uint64)) << high | _ranks(eight[at + length - 8].astype(np.uint64)))
    if length > 16:
        v, cover = 7, COVERS[7]
        depth = max(r for r in range(8, length - v + 2) if r % v == 8 % v)
        if depth < length - 8:
            name = _ranks(name << high | _ranks(eight[at + length - 16].astype(np.uint64)))
        samples = np.sort(np.concatenate([np.arange(r, n + v, v) for r in cover]))
        rank = np.zeros(n + length + v, np.uint64)
        rank[samples] = _ranks(eight[np.minimum(samples, len(eight) - 1)].astype(np.uint64))
        reach = 8
        while reach < depth:
            step = min(reach // v * v, depth - reach)
            rank[samples] = _ranks(rank[samples] << high | rank[np.minimum(samples + step, len(rank) - 1)])
            reach += step
        # each phase sees the three samples of the cover behind it; two suffixes of any phases see one at the same offset
        offsets = np.array([[d for d in range(v) if (p + d) % v in cover] for p in range(v)])[at % v]
        # 30, 3 and 31 bits
        name = np.concatenate([(name << np.uint64(3) | offsets[:, c].astype(np.uint64)) << np.uint64(31) | rank[at + offsets[:, c]] for c in range(len(cover))])
    order, begin = _grouped(name)
    number = np.arange(len(name)) % max(1, len(at))
    first = np.empty(len(name), np.int64)
    first[order] = np.repeat(np.minimum.reduceat(number[order], begin), np.diff(np.append(begin, len(name)))) if len(name) else first
    return first.reshape(-1, len(at)).min(axis=0) if len(at) else first


def _sort_bucket(length: int):
    def sort(key: tuple, table: pa.Table) -> pa.Table:
        """For each suffix of the bucket, or of a part of one: does an earlier one have its bytes?  Places go by document id, chunk and place in the chunk."""
        rows = table.select([chunks.KEY, "texts", "sizes", "ords", "ids"]).to_pylist()
        texts, ids, chunk_of, row_of = [], [], [], []
        for r, row in enumerate(rows):
            own, of = _unpacked(row)
            texts += own
            ids.append(of)
            chunk_of.append(np.full(len(own), row[chunks.KEY]))
            row_of.append(np.full(len(own), r))
        ids, chunk_of, row_of = np.concatenate(ids), np.concatenate(chunk_of), np.concatenate(row_of)
        order = np.lexsort((np.arange(len(texts)), chunk_of, ids))
        # whole runs first: of equal ones the first alone is sorted
        had: dict[bytes, int] = {}
        first = [i for i in order.tolist() if had.setdefault(texts[i], i) == i]
        size = np.array([len(texts[i]) for i in first], np.int64)
        count = size - length + 1
        begin = np.cumsum(size) - size
        at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
        later = first_equal(np.frombuffer(b"".join(texts[i] for i in first), np.uint8), at, length) != np.arange(len(at))
        own = dict(zip(first, np.split(later, np.cumsum(count)[:-1]), strict=True))
        flags: list[list[np.ndarray]] = [[] for _ in rows]
        for i, r in enumerate(row_of.tolist()):
            flags[r].append(own[i] if i in own else np.ones(len(texts[i]) - length + 1, bool))
        bits = [packing.pack_flags(np.concatenate(f)) for f in flags]
        piece = table["part"] if "part" in table.column_names else pa.array([-1] * len(rows), pa.int32())
        return pa.table({chunks.KEY: table[chunks.KEY], "piece": piece, "bucket": table["bucket"], "bits": chunks.binary(bits)})

    return sort


def _remains(chunk: chunks.Chunk, gone: np.ndarray) -> dict[str, pa.Array]:
    """What is removed from each document and what stays."""
    bounds = np.concatenate([[0], chunk.end])
    last = np.zeros(len(gone) + 1, bool)
    last[bounds] = True
    before, after = np.zeros(len(gone), bool), np.zeros(len(gone), bool)
    before[1:], after[:-1] = gone[:-1], gone[1:]
    begin, stop = np.flatnonzero(gone & (~before | last[:-1])), np.flatnonzero(gone & (~after | last[1:])) + 1
    span_at = np.searchsorted(begin, bounds)
    base = np.repeat(chunk.start, np.diff(span_at))
    runs = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(stop - base)], ["start", "end"])
    sums = np.concatenate([[0], np.cumsum(stop - begin)])
    removed = np.diff(sums[span_at])
    offsets = np.concatenate([[0], np.cumsum(chunk.end - chunk.start - removed)]).astype(np.int32)
    kept = pa.BinaryArray.from_buffers(pa.binary(), len(removed), [None, pa.py_buffer(offsets), pa.py_buffer(chunk.data[~gone])])
    return {"n_removed": pa.array(removed, pa.int64()), "spans": pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), runs), "kept": kept}


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Bytes of characters of which a byte goes."""
    number = np.cumsum(data & 0xC0 != 0x80)
    hit = np.zeros(int(number[-1]) + 1 if len(number) else 0, bool)
    hit[number[gone]] = True
    return hit[number]


def _remove(ident: str, text: str, length: int, bits: int, names: list[str], whole: bool = False):
    def remove(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        got = _by_piece(answers)
        later = got.pop(-1, np.zeros(0, bool))
        chunk = chunks.load(docs, ident, text)
        runs = _runs(chunk, length, got, bits)
        marks, at = np.zeros(len(chunk.data) + 1, bool), 0
        for j, _, had in _texts(chunk, runs, length):
            start, count = runs.start[j], runs.count[j]
            marks[start : start + count] = True if had else later[at : at + count]
            at += 0 if had else count
        gone = _reached(np.flatnonzero(marks), len(chunk.data), 0, length - 1)[: len(chunk.data)]
        if whole:
            gone = _whole_characters(chunk.data, gone)
        out = {n: chunk.table[n] for n in names}
        out["n_bytes"] = pa.array(chunk.end - chunk.start, pa.int64())
        return pa.table(out | _remains(chunk, gone))

    return remove


def _sorted(scratch: Scratch, runs: DataFrame, length: int, heavy: int, part_bytes: int, block: int) -> DataFrame:
    """Answers of all buckets, those of more than ``heavy`` bytes by parts."""
    loads = runs.groupBy("bucket").agg(F.sum("raw").alias("load")).where(F.col("load") > heavy)
    # stretches overlap, which makes about three times the bytes of them, and parts are not even
    loads = scratch.write(loads.select("bucket", F.ceil(6 * F.col("load") / part_bytes).cast("int").alias("parts")), f"heavy{block}")
    light = runs if loads.isEmpty() else runs.join(loads, "bucket", "left_anti")
    ties = scratch.write(light.groupBy("bucket").applyInArrow(_sort_bucket(length), _ANSWER), f"ties{block}")
    if loads.isEmpty():
        return ties
    rows = runs.join(loads, "bucket")
    parts = rows.groupBy("bucket", chunks.KEY).applyInArrow(_split_heavy(length), f"bucket int, part int, {_RUNS}")
    told = scratch.write(parts.groupBy("bucket", "part").applyInArrow(_sort_bucket(length), _ANSWER), f"parts{block}")
    whole = rows.groupBy("bucket", chunks.KEY).cogroup(told.groupBy("bucket", chunks.KEY)).applyInArrow(_joined_parts(length), _ANSWER)
    return ties.unionByName(scratch.write(whole, f"whole{block}"))


def remove_repeats(docs: DataFrame, ident: str = "doc_id", text: str = "text", length: int = 100, blocks: int = 1, chunk_bytes: int = 6 << 20, bucket_keys: int = 1_500_000, bucket_bytes: int = 4 << 20, heavy_bytes: int | None = None, characters: bool = False) -> DataFrame:
    """Mark and remove every byte covered by a string of ``length`` bytes that also starts earlier in the corpus.

    Earlier means a smaller id, or the same document and an earlier start; strings are judged on the input.  Returns the input
    columns and ``n_bytes``, ``n_removed`` (long), ``spans`` (removed runs as byte offsets) and ``kept`` (binary, the bytes that
    stay); input columns of these names are replaced.  With ``characters`` a character of which a byte goes goes whole, so that what stays is text.  A null text counts as empty and a null id as smallest; an empty table
    gives an empty result; of equal rows one keeps its text and the others lose theirs if it is long enough.  Texts may be of
    any length: a chunk is worked on in pieces of 2 MB.  A bucket of more than ``heavy_bytes`` (four times ``bucket_bytes`` where none is given) is split.  Buckets are sent and sorted in ``blocks`` turns, each of which reads the texts once and holds
    its share of the tied runs on disk.  ``ident`` must be an integer column and the input must give the same
    rows when a task is run again, as a table does.
    """
    spark = docs.sparkSession
    made = {"n_bytes", "n_removed", "spans", "kept"}
    names = [c for c in docs.columns if c not in made or c in (ident, text)]
    docs = docs.select(*names)
    total = chunks.total_bytes(docs, text)
    keyed = chunks.with_key(docs, ident, text, chunks.count(total, chunk_bytes))
    slim = keyed.select(ident, text, chunks.KEY)
    v = cover_period(length)
    bits = lambda n, most: max(0, int(np.ceil(np.log2(max(1, n / most)))))
    sample_bits, run_bits = bits(total * len(COVERS[v]) / v, bucket_keys), max(bits(total, bucket_bytes), bits(blocks, 1))
    scratch = Scratch(spark, "repeats")
    sent = slim.groupBy(chunks.KEY).applyInArrow(_send_samples(ident, text, length, sample_bits), "bucket int, __chunk int, piece int, keys binary")
    ranks = scratch.write(sent.groupBy("bucket").applyInArrow(_shared_ranks, _ANSWER), "ranks")
    answers = ranks
    for block in range(blocks):
        runs = slim.groupBy(chunks.KEY).cogroup(ranks.groupBy(chunks.KEY)).applyInArrow(_send_runs(ident, text, length, run_bits, block, blocks), _SENT)
        answers = answers.unionByName(_sorted(scratch, scratch.write(runs, f"runs{block}"), length, heavy_bytes or 4 * bucket_bytes, bucket_bytes, block))
        scratch.drop(f"runs{block}")
    schema = T.StructType([docs.schema[n] for n in names]).add("n_bytes", "long").add("n_removed", "long")
    schema = schema.add("spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))).add("kept", "binary")
    return keyed.groupBy(chunks.KEY).cogroup(answers.groupBy(chunks.KEY)).applyInArrow(_remove(ident, text, length, run_bits, names, characters), schema)
