"""Words of whole texts as places in one byte array, for operators that count them a chunk of documents at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import rolling, slices
from .memory import give_back

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


_ROW = 64


def gather(batches: Iterable[pa.RecordBatch], text: str, most: int) -> Iterator[pa.Table]:
    """The batches' rows again, in tables of about ``most`` bytes of text and of rows, a row counting as 64; a longer text is a table of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + _ROW)
        lo = done = 0
        while lo < batch.num_rows:
            hi = min(batch.num_rows, max(int(np.searchsorted(ends, done + most - size, "right")), lo if size else lo + 1))
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                size += int(ends[hi - 1]) - done
                done, lo = int(ends[hi - 1]), hi
            if lo < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                give_back()
    if held:
        yield pa.Table.from_batches(held)


def batches_of(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same as batches."""
    for table in gather(batches, column, most):
        yield from table.combine_chunks().to_batches()


def encoded(column: pa.ChunkedArray, null: str) -> tuple[np.ndarray, list[str]]:
    """Number of each value among the distinct ones, and these; ``null`` stands for a null."""
    coded = pc.dictionary_encode(pc.fill_null(column, null).combine_chunks())
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


@dataclass
class Words:
    """Maximal runs of word bytes inside each document: lower-cased bytes, where the words begin and stop, their documents."""

    data: np.ndarray
    begin: np.ndarray
    stop: np.ndarray
    doc: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        own = [np.zeros(0, np.uint64)]
        for a, b in slices.stretches(self.begin):
            base = self.begin[a]
            own.append(rolling.slices(rolling.prefixes(self.data[base : self.stop[b - 1]]), self.begin[a:b] - base, self.stop[a:b] - base))
        return np.concatenate(own)


def find(text: pa.ChunkedArray, word: np.ndarray) -> Words:
    """Words of the texts (null: none), where ``word`` says of each byte, A-Z lower-cased, whether it is part of one."""
    column = text.combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    blob = column.buffers()[2] if len(column) else None
    data = LOWER[np.frombuffer(blob, np.uint8)[offsets[0] : offsets[-1]]] if blob is not None else np.zeros(0, np.uint8)
    end = offsets[1:] - offsets[0]
    inside = word[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[0] = cut[end] = True
    opens, closes = inside & cut[:-1], inside & cut[1:]
    opens[1:] |= inside[1:] & ~inside[:-1]
    closes[:-1] |= inside[:-1] & ~inside[1:]
    begin = np.flatnonzero(opens)
    return Words(data, begin, np.flatnonzero(closes) + 1, np.searchsorted(end, begin, "right"))


def strings(values: np.ndarray, count: np.ndarray) -> pa.Array:
    """A column of the strings of ``count`` bytes that stand one after another in ``values``; bytes are not validated, as Spark's are not."""
    ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(count), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values)))
