"""Hashes of byte strings by prefix sums: any substring's hash is a difference of two prefixes.

The prefix polynomial is taken modulo 2**64 with a fixed odd base, so NumPy's wrapping sums give it at once.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
BACK = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = 1 << max(12, (n - 1).bit_length())
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = known = np.multiply.accumulate(steps)
    return known[:n]


def prefixes(data: np.ndarray) -> np.ndarray:
    """P with P[0] = 0 and P[i] = sum of (data[j] + 1) * BASE**j for j < i."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def substring(p: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of data[start:stop], alike for equal substrings wherever they lie."""
    return (p[stop] - p[start]) * powers(BACK, len(p))[start]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
