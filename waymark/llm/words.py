"""64-bit codes of words and word shingles."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_WORD = re.compile(r"\w+")
_FACTORS = np.random.default_rng(5).integers(1, 2**63, size=8, dtype=np.uint64) | np.uint64(1)
SHINGLE = 5


class WordCodes(dict):
    """Codes of the words of each white-space separated chunk, as bytes, filled on demand and of bounded size."""

    MOST = 150_000

    def __missing__(self, chunk: str) -> bytes:
        if len(self) > self.MOST:
            self.clear()
        self[chunk] = codes = b"".join(xxhash.xxh3_64_intdigest(w).to_bytes(8, "little") for w in _WORD.findall(chunk.lower()))
        return codes

    def of(self, text: str | None) -> np.ndarray:
        """uint64 codes of a text's words (runs of letters, digits and underscores, lower case)."""
        return np.frombuffer(b"".join(map(self.__getitem__, text.split())) if text else b"", dtype="<u8")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixing step (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(codes: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Codes of all runs of ``k`` words in order; of the whole text if it is shorter (none if it is empty)."""
    k = min(k, len(codes))
    n = len(codes) - k + 1
    if k == 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total += codes[i : i + n] * _FACTORS[i]
    return mix(total)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller over sum of larger multiplicities of two bags of codes; 0 if both are empty."""
    both, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(where[: len(a)], minlength=len(both))
    y = np.bincount(where[len(a) :], minlength=len(both))
    larger = np.maximum(x, y).sum()
    return float(np.minimum(x, y).sum() / larger) if larger else 0.0
