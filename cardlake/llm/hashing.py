"""64-bit hashes of sequences, for whole arrays at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
STEPS = [U(c) for c in (
    0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
    0xE7037ED1A0B428DB)]
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * STEPS[0]
    x = (x ^ (x >> U(27))) * STEPS[1]
    return x ^ (x >> U(31))


def times(step: int, number: int) -> np.uint64:
    return U(int(STEPS[step]) * number & 0xFFFFFFFFFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, U(base))
    steps[0] = 1
    return np.cumprod(steps)


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span ``values[start:end]``, the same wherever the span stands.

    Spans are polynomials modulo 2^64, taken from sums up to their ends.
    """
    size = 1 << max(12, len(values).bit_length())
    if size not in _TABLES:
        _TABLES[size] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    up, down = _TABLES[size]
    terms = (values.astype(U) + U(1)) * up[:len(values)]
    sums = np.concatenate((np.zeros(1, U), np.cumsum(terms)))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
