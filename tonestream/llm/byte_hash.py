"""Hashes of many byte ranges of one buffer, by numpy.

The hash of a range is a polynomial in an odd multiplier modulo 2**64, read off
prefix sums, so each range costs a subtraction and a multiplication; a mixer spreads its bits.
"""

from __future__ import annotations

import numpy as np

FIRST, SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd constants with well spread bits
HALF = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        for factor in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
            x = (x ^ (x >> HALF)) * np.uint64(factor)
        return x ^ (x >> HALF)


POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(multiplier: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    if (multiplier, size) in POWERS:
        return POWERS[multiplier, size]
    up = np.full(size + 1, multiplier, np.uint64)
    down = np.full(size + 1, pow(multiplier, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    POWERS[multiplier, size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return POWERS[multiplier, size]


class Ranges:
    """Hashes of ranges of ``data`` (bytes, or 64-bit numbers)."""

    def __init__(self, data: np.ndarray, multiplier: int = FIRST):
        up, self.down = _powers(multiplier, 1 << max(16, int(len(data)).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """One hash for each range; equal content, equal hash."""
        return mix((self.sums[stop] - self.sums[start]) * self.down[start])
