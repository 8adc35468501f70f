"""Words of whole texts as 64-bit hashes, and hashes of runs of words (numpy, one text at a time)."""
from __future__ import annotations

from functools import partial

import numpy as np
from xxhash import xxh3_64_intdigest

U64 = np.uint64
#: Odd multipliers of the positions of a shingle.
POSITION = np.array([0x9E3779B97F4A7C15 ^ (0x2545F4914F6CDD1D * (2 * i + 1) & (2**64 - 2)) for i in range(64)], dtype=U64) | U64(1)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and xor-shift rounds)."""
    with np.errstate(over="ignore"):
        h = (h ^ U64(seed * 0x9E3779B97F4A7C15 % 2**64)) + U64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
        return h ^ (h >> U64(31))


def hashes(words: list, seed: int = 0) -> np.ndarray:
    """64-bit hashes of words (bytes, or text as UTF-8)."""
    return np.fromiter(map(partial(xxh3_64_intdigest, seed=seed) if seed else xxh3_64_intdigest, words), U64, len(words))


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of *text* (UTF-8), A-Z lower-cased."""
    return hashes(text.lower().split() if text else [])


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of *width* words; a shorter sequence counts as one run."""
    n = len(words)
    if n == 0:
        return np.empty(0, U64)
    with np.errstate(over="ignore"):
        if n < width:
            return mix(np.array([(words * POSITION[:n]).sum(dtype=U64)], U64), 1000 + n)
        h = words[: n - width + 1] * POSITION[0]
        for i in range(1, width):
            h = h + words[i : n - width + 1 + i] * POSITION[i]
    return np.unique(mix(h, width))
