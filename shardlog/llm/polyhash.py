"""Prefix polynomial hashes modulo 2^64, whole arrays at a time.

The hash of a slice is position-free: (sum up to its end - sum up to its start)
times the inverse power of its start. Equal slices have equal hashes; that equal
hashes mean equal slices is for the caller to verify.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3: spreads every bit over all others."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


_tables: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    """base^0, base^1, ... : the longest table so far, or a longer one."""
    if len(_tables.get(base, ())) < size:
        out = np.full(1 << max(12, (size - 1).bit_length()), base, dtype=np.uint64)
        out[0] = 1
        _tables[base] = np.multiply.accumulate(out)
    return _tables[base]


def _values(salt: int) -> np.ndarray:
    """A value for each byte, so that slices of few different bytes differ in all bits."""
    return mixed(np.arange(1, 257, dtype=np.uint64) + np.uint64(salt << 8)) | np.uint64(1)


class PrefixHashes:
    """Of a text, given as an array of bytes; another ``salt`` is another hash. Of an
    array of other numbers, if ``values`` says what each is worth."""

    def __init__(self, data: np.ndarray, salt: int = 0, values: Callable[[np.ndarray], np.ndarray] | None = None):
        n = len(data)
        worth = values(data) | np.uint64(1) if values else _values(salt)[data]
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(worth * _powers(_BASE, n + 1)[:n], out=self.sums[1:])
        self.unshift = _powers(_INVERSE, n + 1)[: n + 1]

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.unshift[starts]

    def grams(self, size: int) -> np.ndarray:
        """Of every slice of ``size`` bytes, mixed."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.unshift[:n])
