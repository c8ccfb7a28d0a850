"""Vectorised 64-bit hashes of all windows of a byte array."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTES = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefixes(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any slice follows; one longer than ``data``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power(_BASE, len(data)), out=out[1:])
    return out


def windows(sums: np.ndarray, length: int, at: np.ndarray | slice) -> np.ndarray:
    """Hashes of the windows of ``length`` bytes that start at ``at``."""
    n = max(0, len(sums) - length)
    back = _power(_INVERSE, len(sums))
    if isinstance(at, slice):
        return mix((sums[length:] - sums[:n])[at] * back[:n][at])
    return mix((sums[at + length] - sums[at]) * back[at])


def slices(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the slices ``start:end``."""
    return mix((sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start] + (end - start).astype(np.uint64))
