"""Word numbers and shingle hashes in numpy, for the operators that compare texts."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Nothing is remembered: looking a word up takes longer than hashing it."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, so that any of their bits may be used alone."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def grams(words: np.ndarray, n: int, base: int = int(_ODD)) -> np.ndarray:
    """Polynomial hashes of all runs of n words, by doubling (wrapping 64-bit arithmetic)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    out, have, power, at = None, 0, words, 0  # power: hashes of runs of 2^i words
    size, factor = 1, np.uint64(base)
    while n >> at:
        if n >> at & 1:
            # runs of `have` words so far, followed by this power's run
            out = power if out is None else _joined(out, have, power, size, factor)
            have += size
        at += 1
        if n >> at:
            power = power[:len(power) - size] * factor + power[size:]
            factor, size = factor * factor, size * 2
    return out[:len(words) - n + 1]


def _joined(first: np.ndarray, have: int, second: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
    n = min(len(first), len(second) - have)
    return first[:n] * factor + second[have:have + n]
