"""Word shingles of whole texts as sets of 64-bit hashes, and their MinHash signatures."""

from __future__ import annotations


import numpy as np
import xxhash

WIDTH = 5
BLOCK = 2_048
ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word. bytes.lower and bytes.split know exactly A-Z, blank and \\t to \\r."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than a shingle count as one, none as none."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(width, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total * ODD + words[k : len(words) - size + 1 + k])
    return np.unique(total)


def minhash_seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    odd = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 2**63, count, dtype=np.uint64)


def signature(shingles: np.ndarray, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least 32-bit value of each hash function over the set."""
    odd, add = seeds
    least = np.full(len(odd), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), BLOCK):
        part = shingles[at : at + BLOCK]
        for k in range(len(odd)):
            value = ((part * odd[k] + add[k]) >> np.uint64(32)).min()
            if value < least[k]:
                least[k] = value
    return least
