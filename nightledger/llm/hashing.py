"""Words, shingles and their 64-bit hashes, as numpy arrays: one call per document, no loop over shingles."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5


def words(text: str | None) -> list[bytes]:
    """Maximal runs without ASCII white space, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def ascii_lower(text: str | None) -> bytes:
    """A-Z in lower case, every other byte as it is."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which any input bit moves all output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_words(tokens: list[bytes], seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(t, seed) for t in tokens) if seed else map(digest, tokens), np.uint64, len(tokens))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words; empty if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for i in range(1, size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[i : i + n]
    total += np.uint64(size)
    return mix(total)


def shingle_set(tokens: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than a shingle make one, no words make none."""
    if not tokens:
        return np.zeros(0, np.uint64)
    return np.unique(windows(hash_words(tokens), min(size, len(tokens))))
