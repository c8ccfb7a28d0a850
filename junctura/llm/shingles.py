"""Word shingles of whole texts as 128-bit keys, computed at once for a chunk of documents.

A word of up to 15 bytes is its own 128-bit code, a longer one has a 120-bit BLAKE2 digest, so different words never meet by their structure.  A
shingle's two 64-bit halves are independent mixed sums of its words' codes: n shingles hold about n*n/2**129 false pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from . import rolling

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_PIECE = 2 << 20
_INLINE = 15
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_TOP = np.uint64(56)
_FACTORS = np.random.default_rng(7).integers(0, 2**63, (2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = np.random.default_rng(11).integers(0, 2**63, (2, 2), dtype=np.uint64)


def _codes(part: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for each word ``begin:stop`` of ``part``: its bytes and length, or a digest where it is longer than 15 bytes."""
    eight = np.ndarray(len(part) + 9, "<u8", np.concatenate([part, np.zeros(16, np.uint8)]), strides=(1,))  # the 8 bytes from each place on
    size = stop - begin
    out = np.empty((2, len(begin)), np.uint64)
    out[0] = eight[begin] & _MASKS[np.minimum(size, 8)]
    out[1] = eight[begin + 8] & _MASKS[np.clip(size - 8, 0, 7)] | np.minimum(size, _INLINE).astype(np.uint64) << _TOP
    known: dict[bytes, tuple[int, int]] = {}
    for i in np.flatnonzero(size > _INLINE).tolist():
        word = part[begin[i] : stop[i]].tobytes()
        if word not in known:
            d = hashlib.blake2b(word, digest_size=16).digest()
            known[word] = int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little") | 0xFF << 56
        out[0, i], out[1, i] = known[word]
    return out


def word_codes(data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit code (two rows) and document of every word ``[^\\x20\\x09-\\x0D]+``, A-Z as a-z; ``end`` has the documents' ends in ``data``."""
    codes, docs, lo, n = [np.zeros((2, 0), np.uint64)], [np.zeros(0, np.int64)], 0, len(data)
    while lo < n:
        hi = min(lo + _PIECE, n)
        while hi < n:  # to the next gap between words
            gap = np.flatnonzero(_SPACE[data[hi : hi + _PIECE]])
            if len(gap):
                hi += int(gap[0])
                break
            hi = min(hi + _PIECE, n)
        part = _LOWER[data[lo:hi]]
        word = ~_SPACE[part]
        cut = np.zeros(len(part) + 1, bool)
        inner = end[(end >= lo) & (end <= hi)] - lo
        cut[0] = cut[-1] = True
        cut[inner] = True
        before, after = np.zeros(len(part), bool), np.zeros(len(part), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        begin = np.flatnonzero(word & (~before | cut[:-1]))
        stop = np.flatnonzero(word & (~after | cut[1:])) + 1
        codes.append(_codes(part, begin, stop))
        docs.append(np.searchsorted(end, begin + lo, "right"))
        lo = hi
    return np.concatenate(codes, axis=1), np.concatenate(docs)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct columns of two rows of keys, sorted."""
    s = keys[:, np.argsort(keys[0], kind="stable")]
    same = s[0, 1:] == s[0, :-1]
    if (same & (s[1, 1:] != s[1, :-1])).any():  # two keys share their first half
        s = keys[:, np.lexsort((keys[1], keys[0]))]
        same = (s[:, 1:] == s[:, :-1]).all(axis=0)
    return s[:, np.concatenate([[True], ~same])]


def shingle_sets(data: np.ndarray, end: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Each document's distinct shingles as two rows of 64-bit halves, sorted; a shorter document has its whole word sequence as one, one without words none."""
    codes, doc = word_codes(data, end)
    n = codes.shape[1]
    words = np.stack([rolling.mix((codes[0] ^ a) + rolling.mix(codes[1] ^ b)) for a, b in _SALTS]) if n else codes
    bounds = np.searchsorted(doc, np.arange(len(end) + 1))
    whole = np.zeros((2, max(0, n - width + 1)), np.uint64)
    for j in range(width if n >= width else 0):
        whole += words[:, j : n - width + 1 + j] * _FACTORS[:, j, None]
    whole = rolling.mix(whole + np.uint64(width))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            yield _distinct(whole[:, a : b - width + 1])
        elif b > a:
            yield rolling.mix(np.sum(words[:, a:b] * _FACTORS[:, : b - a], axis=1, dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield words[:, :0]


def signature(keys: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(keys.tobytes(), digest_size=16).digest()
