"""Elias-Fano sequences on numpy arrays.

A non-decreasing sequence of n values is split into low parts (whole bytes,
packed) and high parts (a bit vector with one 1 a value and one 0 a step of the
high part). Both can live in a memory-mapped file. All queries take arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ONE = np.uint64(1)


def _select(words: np.ndarray, directory: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Places of the ``k``-th (from 0) set bits; ``directory[i]`` counts the set bits before word i."""
    w = np.searchsorted(directory, k, side="right") - 1
    left = (k - directory[w]).astype(np.int64)
    x = words[w].copy()
    place = np.zeros(len(k), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(x & np.uint64((1 << half) - 1)).astype(np.int64)
        up = left >= below
        left -= np.where(up, below, 0)
        place += np.where(up, half, 0)
        x = np.where(up, x >> np.uint64(half), x)
    return w * 64 + place


@dataclass
class EliasFano:
    n: int
    low_bytes: int
    low: np.ndarray  # uint8, n x low_bytes
    high: np.ndarray  # uint64 words
    ones: np.ndarray  # set bits before each word
    zeros: np.ndarray  # clear bits before each word

    @staticmethod
    def encode(values: np.ndarray) -> EliasFano:
        values = np.ascontiguousarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bytes = max(0, -(-((top // max(1, n)).bit_length()) // 8))
        low = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low_bytes].copy()
        parts = (values >> np.uint64(8 * low_bytes)) if low_bytes < 8 else np.zeros(n, np.uint64)
        size = n + (int(parts[-1]) if n else 0) + 1
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[parts.astype(np.int64) + np.arange(n)] = 1
        return EliasFano.of(n, low_bytes, low, np.packbits(bits, bitorder="little").view(np.uint64))

    @staticmethod
    def of(n: int, low_bytes: int, low: np.ndarray, high: np.ndarray) -> EliasFano:
        count = np.bitwise_count(high).astype(np.int64)
        ones = np.concatenate([[0], np.cumsum(count)[:-1]]) if len(high) else np.zeros(0, np.int64)
        return EliasFano(n, low_bytes, low, high, ones, np.arange(len(high)) * 64 - ones)

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for b in range(self.low_bytes):
            out |= self.low[at, b].astype(np.uint64) << np.uint64(8 * b)
        return out

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        high = (_select(self.high, self.ones, i) - i).astype(np.uint64)
        return (high << np.uint64(8 * self.low_bytes) if self.low_bytes < 8 else np.zeros(len(i), np.uint64)) | self._low(i)

    def successor(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """In each range ``[lo, hi)`` the first place whose value is at least ``x`` (``hi`` if there is none)."""
        lo, hi = lo.astype(np.int64).copy(), hi.astype(np.int64).copy()
        if not self.n or not len(x):
            return lo
        part = (x >> np.uint64(8 * self.low_bytes)).astype(np.int64) if self.low_bytes < 8 else np.zeros(len(x), np.int64)
        steps = len(self.high) * 64 - self.n  # clear bits there are
        # values with a high part below h: the bits before the h-th clear bit, less the clear ones
        before = lambda h: np.where(h <= 0, 0, np.where(h > steps, self.n, _select(~self.high, self.zeros, np.clip(h - 1, 0, steps - 1)) - (h - 1)))
        first = np.minimum(np.maximum(lo, before(part)), hi)
        last = np.maximum(np.minimum(hi, before(part + 1)), first)
        low = x & np.uint64((1 << 8 * self.low_bytes) - 1)
        open_ = np.flatnonzero(first < last)
        while len(open_):
            mid = (first[open_] + last[open_]) >> 1
            less = self._low(mid) < low[open_]
            first[open_] = np.where(less, mid + 1, first[open_])
            last[open_] = np.where(less, last[open_], mid)
            open_ = open_[first[open_] < last[open_]]
        return first
