"""64-bit fingerprints of words and word sequences, a whole text at a time."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(97).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 14)
        for name, base in (("up", int(BASE)), ("down", pow(int(BASE), -1, 2**64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each byte span [start, end) of ``raw`` (uint8)."""
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE.take(raw) * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Order-dependent sums of every ``width`` neighbouring values (not yet mixed)."""
    n = len(values) - width + 1
    acc = values[:n].copy()
    for k in range(1, width):
        acc += values[k:k + n] * np.uint64(pow(int(BASE), k, 2**64))
    return acc
