"""Word shingles and MinHash signatures over raw UTF-8 bytes (NumPy, no Spark)."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(33)


class WordHashes(dict):
    """Remembers the 64-bit hash of up to ``limit`` words of 40 bytes at most; other words are hashed each time."""

    def __init__(self, limit: int = 30_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit and len(word) <= 40:
            self[word] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """Murmur's 64-bit finaliser."""
    x = (x ^ (x >> _SHIFT)) * _MIX1
    x = (x ^ (x >> _SHIFT)) * _MIX2
    return x ^ (x >> _SHIFT)


def shingle_set(text: str | None, width: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a whole text.

    Words are runs of anything but space and 0x09-0x0D, with A-Z in lower case. A text with fewer words has its whole
    word sequence as its one shingle; without words the set is empty.
    """
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, split), np.uint64, len(split))
    with np.errstate(over="ignore"):
        take = min(width, len(h))
        out = np.full(len(h) - take + 1, take, np.uint64)
        for i in range(take):
            out = out * _STEP + h[i : len(h) - take + 1 + i]
        out = mix(out)
    return np.unique(out)


def coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 64) -> np.ndarray:
    """One 32-bit minimum per hash function; shingles go through in blocks, so memory stays small for long texts."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), block):
        x = low[at : at + block, None] * a
        x += b
        np.minimum(out, x.min(0), out)
    return out


def fingerprint(shingles: np.ndarray) -> bytes:
    """128-bit digest of a set; equal sets have equal digests."""
    return xxhash.xxh3_128_digest(shingles.tobytes())
