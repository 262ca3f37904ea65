"""Word shingles of a text as 64-bit hashes, the same on every machine."""

from __future__ import annotations

import numpy as np

CACHED_WORDS = 50_000
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Words are runs of characters other than `[\\x20\\x09-\\x0D]`, A-Z lower-cased."""

    def __init__(self, width: int, cached_words: int = CACHED_WORDS):
        import xxhash

        self.hash, self.width, self.cached_words = xxhash.xxh3_64_intdigest, width, cached_words
        self.cache: dict[bytes, int] = {}

    def words(self, text: str | None) -> list[bytes]:
        return (text or "").encode("utf-8", "surrogatepass").lower().split()

    def sorted_set(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct shingle hashes; with fewer words than the width, the whole sequence is one shingle."""
        if not words:
            return np.empty(0, dtype=np.uint64)
        cache = self.cache
        new = set(words).difference(cache)
        if new:
            if len(cache) + len(new) > self.cached_words:
                cache.clear()
                new = set(words)
            for w in new:
                cache[w] = self.hash(w)
        h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.width, len(h))
        out = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            out = mix(out + h[k : len(h) - width + 1 + k] * np.uint64(2 * k + 1))
        return np.unique(out)
