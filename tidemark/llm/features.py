"""Hashed words and character n-grams of a text, with numpy."""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint32)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    return ((x ^ (x >> np.uint64(32))) % np.uint64(buckets)).astype(np.int32)


def ngram_buckets(points: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """A bucket per character n-gram; other lengths hash otherwise."""
    m = len(points) - n + 1
    if m <= 0:
        return np.zeros(0, np.int32)
    p = points.astype(np.uint64)
    h = p[:m] + np.uint64(n)
    for i in range(1, n):
        h = h * _M1 + p[i : i + m]
    return _bucket(h, buckets)


def word_buckets(points: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket per word, a run of code points that are no ASCII white space."""
    inside = ~((points == 32) | ((points >= 9) & (points <= 13)))
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.int32)
    # each code point is mixed with its place in the word, so the sums tell orders apart
    place = np.arange(len(points)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(points)]))
    x = (points.astype(np.uint64) + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _M1
    x ^= x >> np.uint64(29)
    x[~inside] = 0
    return _bucket(np.add.reduceat(x, starts) + (ends - starts).astype(np.uint64), buckets)
