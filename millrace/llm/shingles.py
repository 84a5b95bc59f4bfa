"""Word shingles as 64-bit hashes, shared by the operators on near copies.

A word is a maximal run of Unicode word characters, lower-cased. A shingle is
``size`` consecutive words; a text of 1 to ``size - 1`` words is one shingle of
all its words, a text without words has none. Null counts as empty.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

SHINGLE_WORDS = 5
#: Distinct words whose hash a task remembers before it starts afresh.
WORD_CACHE = 400_000

_WORD = re.compile(r"\w+")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class WordHashes(dict):
    """word -> 64-bit hash, filled on demand and emptied at ``WORD_CACHE`` words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingle_hashes(text: str | None, cache: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all shingles of a text in order, repeats included."""
    if not 1 <= size <= len(_MULTIPLIERS):
        raise ValueError(f"shingles take 1 to {len(_MULTIPLIERS)} words")
    ws = words(text)
    n = len(ws)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, ws), np.uint64, n)
    k = min(size, n)
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total += mix(h[i : n - k + 1 + i] + _MULTIPLIERS[i]) * _MULTIPLIERS[i]
    return mix(total)


def shingle_set(text: str | None, cache: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    return np.unique(shingle_hashes(text, cache, size))


def set_fingerprint(values: np.ndarray) -> bytes:
    """128 bits that stand for an ascending set of shingle hashes."""
    return xxhash.xxh3_128_digest(values.tobytes())
