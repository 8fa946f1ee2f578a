"""Words and word shingles of UTF-8 text as 64-bit hashes, computed on whole Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from quarry.llm.common import mix64

SLAB_BYTES = 1 << 20


def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value per byte with A-Z folded to a-z, and which bytes separate words."""
    low = np.arange(256, dtype=np.uint64)
    low[65:91] += np.uint64(32)
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return mix64(low + np.uint64(0x5851F42D4C957F2D)), space


def slabs(offsets: np.ndarray, most: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes (a longer row stands alone)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = b


def word_hashes(data: np.ndarray, offsets: np.ndarray, values: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the offsets of each row's words. Words never cross rows."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[firsts] = inside[firsts]
    starts = np.flatnonzero(start)
    if len(starts) == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.arange(n, dtype=np.int64)
    at -= starts[np.maximum(np.cumsum(start) - 1, 0)]
    at[~inside] = 0
    power = np.ones(int(at.max()) + 2, np.uint64)
    power[1:] = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    np.cumprod(power, out=power)
    term = values[data] * power[at]
    term[~inside] = 0
    return mix64(np.add.reduceat(term, starts)), np.searchsorted(starts, offsets).astype(np.int64)


def row_shingles(words: np.ndarray, ends: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of ``size`` words of each row; a row of fewer words gives its whole
    sequence as one, a row without words none."""
    total = len(words)
    if total >= size:
        roll = words[: total - size + 1].copy()
        for k in range(1, size):
            roll = roll * np.uint64(0xD6E8FEB86659FD93) + words[k: total - size + 1 + k]
        roll = mix64(roll)
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(roll[a: b - size + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for w in words[a:b]:
                h = h * np.uint64(0xD6E8FEB86659FD93) + w
            out.append(mix64(h))
        else:
            out.append(np.empty(0, np.uint64))
    return out
