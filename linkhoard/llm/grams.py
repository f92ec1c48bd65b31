"""Hashes of words and character n-grams of many texts at once, by prefix sums.

The hash of symbols ``x[s:e]`` is ``sum((x[s+k] + 1) * M**k)`` modulo 2**64. It is taken from running sums
over the whole batch, so the cost per symbol does not depend on the length of words and n-grams.
"""

from __future__ import annotations

import numpy as np

MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", MULTIPLIER), ("down", INVERSE)):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def running(symbols: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)], out=sums[1:])
    return sums


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``[starts, ends)``."""
    _, down = _powers(len(sums))
    return (sums[ends] - sums[starts]) * down[starts]


def windows(sums: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` symbols."""
    _, down = _powers(len(sums))
    count = max(0, len(sums) - n)
    return (sums[n:] - sums[:count]) * down[:count]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + np.uint64(salt * MULTIPLIER & (1 << 64) - 1)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def buckets(x: np.ndarray, bits: int, salt: int = 0) -> np.ndarray:
    return (mix(x, salt) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - bits)).astype(np.int64)


def word_edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    steps = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
