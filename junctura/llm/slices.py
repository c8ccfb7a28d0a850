"""Distinct slices of a byte array, found by hash and compared byte by byte."""

from __future__ import annotations

import numpy as np

from . import rolling

_STRETCH = 1 << 20


def take(values: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The slices ``begin : begin + count`` of ``values``, one after another."""
    ends = np.cumsum(count)
    return values[np.repeat(begin - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]


def stretches(starts: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of slices that begin within about one stretch of bytes each."""
    if not len(starts):
        return []
    cuts = np.unique(np.searchsorted(starts, np.arange(0, starts[-1] + 1, _STRETCH)))
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(starts)], strict=True))


def distinct_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct slices, most frequent first, and each slice's place among them; slices are in order and do not overlap."""
    width = ends - starts
    parts = stretches(starts)
    own = [rolling.slices(rolling.prefixes(data[starts[a] : ends[b - 1]]), starts[a:b] - starts[a], ends[a:b] - starts[a]) for a, b in parts]
    _, first, inverse, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]), return_index=True, return_inverse=True, return_counts=True)
    size, like = width[first], starts[first]
    # every slice is compared with the one that stands for it
    if (size[inverse] != width).any() or not all(np.array_equal(take(data, like[inverse[a:b]], width[a:b]), take(data, starts[a:b], width[a:b])) for a, b in parts):
        items = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]  # two slices with one hash
        place = {w: i for i, w in enumerate(dict.fromkeys(items))}
        return list(place), np.array([place[w] for w in items], np.int64)
    by = np.argsort(-times, kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    return [data[a : a + n].tobytes() for a, n in zip(like[by].tolist(), size[by].tolist(), strict=True)], rank[inverse]
