"""Word shingles of a text as sorted distinct 64-bit values."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import blocks, capped

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
CACHE_WORDS = 300_000
#: Odd factors by place in a shingle, from one starting value.
_FACTORS = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1) ** 3) % 2**64 | 1 for i in range(64)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingles of ``width`` words; a shorter text is one shingle, one without words has none."""

    def __init__(self, width: int):
        if not 1 <= width <= len(_FACTORS):
            raise ValueError("width must be 1 to 64")
        self.width = width
        self.known: dict[bytes, int] = {}

    def words(self, data: bytes) -> np.ndarray:
        """A 64-bit value of each word (A-Z lower-cased, split at ASCII white space)."""
        out = []
        for block in blocks(data):
            words = block.translate(LOWER).split()
            known = capped(self.known, CACHE_WORDS)
            for w in set(words).difference(known):
                known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))
        return out[0] if len(out) == 1 else np.concatenate(out)

    def __call__(self, data: bytes) -> np.ndarray:
        w = self.words(data)
        if not len(w):
            return w
        width = min(self.width, len(w))
        total = np.full(len(w) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            total += w[i : len(w) - width + 1 + i] * _FACTORS[i]
        return np.unique(mix(total))
