"""Hashes of byte ranges from running sums: any range of a text in constant time, whole arrays at once.

The sum of T[byte] * BASE^place modulo 2^64 over a range, divided by BASE^start, does not depend on where the
range stands. T is a table of random numbers; the result is mixed before use.
"""

from __future__ import annotations

import numpy as np

_SEED = np.random.default_rng(20240101)
TABLE = _SEED.integers(1, 1 << 63, 256, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """At least ``n`` powers of the base and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            _powers[k] = np.full(1 << n.bit_length(), base, np.uint64)
            _powers[k][0] = 1
            np.cumprod(_powers[k], out=_powers[k])
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class ByteSums:
    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(TABLE[data] * self.up[:len(data)], out=self.total[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.total[ends] - self.total[starts]) * self.down[starts])

    def every(self, size: int) -> np.ndarray:
        """Of all ranges of one size, by their start."""
        n = len(self.total) - size
        return mixed((self.total[size:] - self.total[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)
