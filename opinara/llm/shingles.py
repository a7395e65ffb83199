"""Word shingles as numbers, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.random.default_rng(4).integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)

#: Words whose hashes a worker remembers.
REMEMBERED = 400_000


class WordCodes(dict):
    """Word (bytes) to a 64-bit hash, computed once per word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased: bytes know ASCII white space and case only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def codes_of(words: list[bytes], codes: WordCodes) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))


def shingle_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every run of ``width`` words; the whole sequence as one if it is shorter."""
    n = len(codes)
    if n == 0:
        return codes
    width = min(width, n)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += codes[i : n - width + 1 + i] * _MIX[i]
    return mixed(total)
