"""Compact binary columns for sorted keys, small integers and flags.  Pure functions on numpy arrays, used inside tasks."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as byte planes of their differences."""
    if not len(keys):
        return b""
    d = np.diff(keys)
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return struct.pack("<QQB", int(keys[0]), len(keys), width) + zstandard.compress(planes, 1)


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    first, n, width = struct.unpack_from("<QQB", blob)
    planes = np.frombuffer(zstandard.decompress(blob[17:]), np.uint8)
    d = np.zeros((n - 1, 8), np.uint8)
    if n > 1:
        d[:, :width] = planes.reshape(width, n - 1).T
    out = np.empty(n, np.uint64)
    out[0] = first
    out[1:] = d.view(np.uint64).reshape(-1)
    return np.cumsum(out, dtype=np.uint64)


def pack_ints(values: np.ndarray) -> bytes:
    """Non-negative integers as byte planes."""
    v = np.ascontiguousarray(values, np.uint64)
    width = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return struct.pack("<QB", len(v), width) + zstandard.compress(planes, 1)


def unpack_ints(blob: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", blob)
    planes = np.frombuffer(zstandard.decompress(blob[9:]), np.uint8)
    v = np.zeros((n, 8), np.uint8)
    v[:, :width] = planes.reshape(width, n).T
    return v.view(np.uint64).reshape(-1)


def pack_flags(flags: np.ndarray) -> bytes:
    return struct.pack("<Q", len(flags)) + zstandard.compress(np.packbits(flags).tobytes(), 1)


def unpack_flags(blob: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<Q", blob)
    return np.unpackbits(np.frombuffer(zstandard.decompress(blob[8:]), np.uint8), count=n).astype(bool)
