"""Word-shingle sets as sorted 64-bit fingerprints (words: runs of non-white-space, A-Z lower-cased).

With a fixed key, different shingles of equal fingerprint can be searched for and put into texts; who needs the sets
exact draws a key for each run, so that two shingles of any texts meet by chance only.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble, so that neighbouring values fall far apart."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: An odd factor for each place in a window (of up to 64 words).
_FACTORS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def word_hashes(words: list[bytes], key: int = 0) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(key)), np.uint64, len(words))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words; for fewer words one for the whole sequence; none without words."""
    n = len(h)
    if n == 0:
        return h
    if n < size:
        return mixed((h * _FACTORS[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total += h[k:n - size + 1 + k] * _FACTORS[k]
    return mixed(total)


def shingle_set(text: str, size: int, key: int = 0) -> np.ndarray:
    """The sorted distinct shingles of a text."""
    return np.unique(windows(word_hashes(text.encode().lower().split(), key), size))


def shingle_set_with_lengths(text: str, size: int, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles and the bytes that each one's words have together."""
    words = text.encode().lower().split()
    s, first = np.unique(windows(word_hashes(words, key), size), return_index=True)
    n = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.concatenate([[0], np.cumsum(n)])
    k = min(size, len(words))
    return s, (ends[k:] - ends[:len(ends) - k])[first] if len(words) else np.zeros(0, np.int64)
