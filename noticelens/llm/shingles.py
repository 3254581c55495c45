"""Word shingles as 64-bit hashes, for the operators that compare documents."""

from __future__ import annotations

import numpy as np
import xxhash

from noticelens.llm.common import utf8

_CACHE_WORDS = 500_000


class WordHashes(dict):
    """word -> 64-bit hash, remembered for the words of one task up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, width: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of all shingles in text order, repeats included.

    Lower-cases A-Z; words are runs without the six ASCII white space characters. A
    text of fewer than ``width`` words is one shingle, one without words has none.
    """
    words = utf8(text).lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(width, len(words))
    total = np.full(len(words) - span + 1, span, dtype=np.uint64)
    for n in range(span):
        total = _mixed(total + h[n : len(words) - span + 1 + n])
    return total
