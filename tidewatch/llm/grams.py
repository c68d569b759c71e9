"""Hashes of words and of runs of words, and the choice of the least hash per window."""

from __future__ import annotations

import numpy as np
import xxhash

#: distinct words whose hash is remembered by a Python worker
REMEMBERED = 1 << 18
_FACTOR = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


class _Words(dict):
    """word -> 64-bit hash, forgotten as a whole when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, by the position of its first word."""
    count = max(0, len(hashes) - length + 1)
    found = np.full(count, length, np.uint64)
    factor = 1
    for j in range(length):
        factor = factor * _FACTOR & _ALL
        found += hashes[j : j + count] * np.uint64(factor)
    return _mixed(found)


def least_per_window(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` grams the position of its least one, the last of equal ones."""
    count = max(0, len(grams) - width + 1)
    least, place = grams[:count].copy(), np.zeros(count, np.int64)
    for j in range(1, width):
        here = grams[j : j + count]
        lower = here <= least
        least[lower] = here[lower]
        place[lower] = j
    return place + np.arange(count)


def in_filter(hashes: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    """Whether both positions of each hash are set (see bloom.positions)."""
    found = np.ones(len(hashes), bool)
    for place in (hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) & np.uint64(bits - 1)):
        byte = bitmap[(place >> np.uint64(3)).astype(np.int64)]
        found &= (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found
