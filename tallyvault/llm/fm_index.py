"""A compressed FM-index over word sequences, in numpy: wavelet matrix, batched backward search."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a count before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n // 64 + 1) * 8, np.uint8)
        own = np.packbits(bits, bitorder="little")
        packed[:len(own)] = own
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = n - int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Index of symbol sequences for patterns of up to ``depth`` symbols.

    ``texts`` is the sequences' symbols (1 and up) with a 0 after each.  Suffixes are sorted by
    their first symbols only, as many as a pattern may have and more.
    """

    def __init__(self, texts: np.ndarray, depth: int):
        n = len(texts)
        rank = texts.astype(np.int64)
        width = 1
        while width < depth + 1:
            ahead = np.zeros(n, np.int64)
            ahead[:max(0, n - width)] = rank[width:]
            both = rank * (int(rank.max()) + 1) + ahead
            order = np.argsort(both, kind="stable")
            ranks = np.cumsum(np.concatenate([[0], np.diff(both[order]) != 0]))
            rank = np.empty(n, np.int64)
            rank[order] = ranks
            width *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        last = texts[self.suffixes - 1]  # the symbol before each suffix
        self.before = np.concatenate([[0], np.cumsum(np.bincount(texts))])
        self.levels: list[BitVector] = []
        for shift in range(int(texts.max()).bit_length() - 1, -1, -1):
            bits = (last >> shift & 1).astype(np.uint8)
            self.levels.append(BitVector(bits))
            last = np.concatenate([last[bits == 0], last[bits == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first ``at`` symbols of the transform."""
        start = np.zeros_like(at)
        top = len(self.levels) - 1
        for k, level in enumerate(self.levels):
            one = (symbols >> (top - k) & 1).astype(bool)
            a, b = level.rank(start), level.rank(at)
            start = np.where(one, level.zeros + a, start - a)
            at = np.where(one, level.zeros + b, at - b)
        return at - start

    def intervals(self, patterns: np.ndarray, own: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The suffix interval [low, high) of every row of ``patterns`` (symbols under 1 are in no text), and
        which searches stopped early.

        Patterns that fail leave the search at once.  With ``own`` the patterns are taken from the
        indexed texts, and a search stops when one place is left: it is the pattern's own.  The
        interval then holds that place, a few symbols into the pattern.
        """
        n = len(patterns)
        low, high, alone = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        live, a, b = np.arange(n), np.zeros(n, np.int64), np.full(n, len(self.suffixes), np.int64)
        known = len(self.before) - 2
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, k]
            ok = (c > 0) & (c <= known)
            if not ok.all():
                live, a, b, c = live[ok], a[ok], b[ok], c[ok]
            both = self.rank(np.concatenate([c, c]), np.concatenate([a, b]))
            a, b = self.before[c] + both[:len(c)], self.before[c] + both[len(c):]
            stays = a + 1 < b if own and k else a < b
            if not stays.all():
                if own and k:
                    single = a + 1 == b
                    low[live[single]], high[live[single]], alone[live[single]] = a[single], b[single], True
                live, a, b = live[stays], a[stays], b[stays]
        low[live], high[live] = a, b
        return low, high, alone


def least_in(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least value in each interval; the intervals are empty, equal or apart.  Empty: the largest int64."""
    out = np.full(len(low), np.iinfo(np.int64).max)
    full = np.flatnonzero(low < high)
    if len(full):
        start, which = np.unique(low[full], return_inverse=True)
        end = np.zeros(len(start), np.int64)
        end[which] = high[full]
        cuts = np.stack([start, end], 1).reshape(-1)
        padded = np.append(values, out[0])
        out[full] = np.minimum.reduceat(padded, cuts)[::2][which]
    return out
