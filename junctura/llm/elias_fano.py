"""Elias-Fano coding of sorted integers, with selection by sampled positions.  Pure functions on numpy arrays."""

from __future__ import annotations

import struct

import numpy as np

_STEP = 256


class EliasFano:
    """Sorted non-negative integers in about ``2 + log2(range / count)`` bits each.

    The lower bits lie side by side; the upper parts are a bit vector with a one at ``upper + place``.  Every 256th one's place is
    sampled, so that the i-th value is found by a short scan from its sample.
    """

    def __init__(self, n: int, low: int, lows: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low, self.lows, self.high, self.samples = n, low, lows, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low = max(0, (top // n).bit_length() - 1) if n else 0
        bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
        marks = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        marks[ones] = 1
        return cls(n, low, np.packbits(bits.reshape(-1)), np.packbits(marks), ones[::_STEP].astype(np.uint32 if top < 1 << 31 else np.uint64))

    def tobytes(self) -> bytes:
        wide = self.samples.dtype.itemsize
        return struct.pack("<QBBQQ", self.n, self.low, wide, len(self.lows), len(self.high)) + self.lows.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def frombytes(cls, blob: bytes) -> tuple[EliasFano, int]:
        """The sequence and the number of bytes it takes."""
        n, low, wide, a, b = struct.unpack_from("<QBBQQ", blob)
        at = struct.calcsize("<QBBQQ")
        count = -(-n // _STEP)
        lows, high = np.frombuffer(blob, np.uint8, a, at), np.frombuffer(blob, np.uint8, b, at + a)
        samples = np.frombuffer(blob, np.uint32 if wide == 4 else np.uint64, count, at + a + b)
        return cls(n, low, lows, high, samples), at + a + b + count * wide

    def _lows(self, start: int, stop: int) -> np.ndarray:
        if not self.low:
            return np.zeros(stop - start, np.uint64)
        a, b = start * self.low, stop * self.low
        bits = np.unpackbits(self.lows[a // 8 : -(-b // 8)])[a % 8 : a % 8 + b - a].reshape(-1, self.low).astype(np.uint64)
        return bits @ (np.uint64(1) << np.arange(self.low, dtype=np.uint64))

    def select(self, start: int, stop: int) -> np.ndarray:
        """Values at places ``start`` to ``stop``; reads from the sample before ``start`` to that after ``stop``."""
        if stop <= start:
            return np.zeros(0, np.uint64)
        first = start // _STEP
        begin = int(self.samples[first])
        after = -(-stop // _STEP)
        end = int(self.samples[after]) if after < len(self.samples) else len(self.high) * 8
        ones = np.flatnonzero(np.unpackbits(self.high[begin // 8 : end // 8 + 1])[begin % 8 :]) + begin
        ones = ones[start - first * _STEP : stop - first * _STEP]
        return ((ones - np.arange(start, stop)).astype(np.uint64) << np.uint64(self.low)) | self._lows(start, stop)
