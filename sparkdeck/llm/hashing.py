"""Word hashes for Python tasks: a bounded cache of 64-bit xxHash values and mixers."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64


class WordHash(dict):
    """word (bytes) -> 64-bit hash; forgets all words when ``keep`` are held."""

    def __init__(self, seed: int = 0, keep: int = 300_000):
        super().__init__()
        self.seed, self.keep = seed, keep

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.keep:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), _U, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (multiply and xor-shift)."""
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive values (order counts); one of all values if fewer."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, _U)
    for k in range(n):
        out = (out + h[k:k + len(out)]) * _U(0x9E3779B97F4A7C15)
        out ^= out >> _U(31)
    return mix(out + _U(n))
