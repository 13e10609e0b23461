"""Benchmark decontamination: item-sized windows, SimHash, multi-index blocks, exact verification.

Every item of the benchmark has a fingerprint: the SimHash of its 5-word shingles, weighted by
how few items have them (with the roots of the weights, so that the angle follows the weighted
overlap).  A document is read in windows of the items' own sizes.  A window
that shares no shingle with an item has similarity zero to it, so fingerprints are taken of
the windows around shared shingles only.  Two 64-bit fingerprints within ``RADIUS`` bits agree
within ``RADIUS // 4`` bits in one of four 16-bit blocks; tables of all such block values give
every item within the radius.  The candidates' weighted Jaccard similarity is then computed
exactly, and ``THRESHOLD`` percent or more is a leak.

Fingerprints may miss windows.  An item that leaks has as much of its weight in the document,
so the items of which that holds are swept: running sums bound the similarity of every window
from above, and windows whose bound is over the best one found are computed exactly.

The items go to the tasks in slices of bounded size (``SLICE_BYTES`` of text); a benchmark of
many slices takes as many passes.  How many items have a shingle is counted once over the whole
benchmark; the counts above one go to every task, whatever its slice.

Defined results: null texts have no windows; items without words match nothing; items under
five words match the same words in a row; a document shorter than an item is one window;
repeated rows give repeated results; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_frames, ship, whole_text
from .shingles import mixed, shingle_set, windows, word_hashes

SIZE = 5
THRESHOLD = 80
RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
SLICE_BYTES = 4 << 20
FILTER_BITS = 20
#: Windows fingerprinted at a time.
CHUNK = 8192
_MASKS = np.array([sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in combinations(range(BLOCK_BITS), r)], np.uint64)


def fingerprints(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of ``size`` shingles from each start on: bit b is set when more weight has it set than not."""
    bits = (mixed(shingles + np.uint64(1))[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    signed = np.where(bits == 1, weights[:, None], -weights[:, None])
    total = np.concatenate([np.zeros((1, 64)), np.cumsum(signed, 0)])
    on = np.round(total[starts + size] - total[starts], 9) > 0
    return np.packbits(on, axis=1, bitorder="little").view("<u8")[:, 0]


def _filter(keys: np.ndarray) -> np.ndarray:
    """Whether any key begins with these ``FILTER_BITS`` bits."""
    out = np.zeros(1 << FILTER_BITS, bool)
    out[(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return out


def _places(keys: np.ndarray, maybe: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Index of each shingle among the sorted keys, -1 for the others."""
    out = np.full(len(shingles), -1)
    hits = np.flatnonzero(maybe[(shingles >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    if len(hits):
        at = np.minimum(np.searchsorted(keys, shingles[hits]), len(keys) - 1)
        out[hits] = np.where(keys[at] == shingles[hits], at, -1)
    return out


class SameSize:
    """Multi-index over the fingerprints of items of one size."""

    def __init__(self, items: list[int], marks: np.ndarray):
        self.items, self.marks = np.array(items), marks
        self.table = np.zeros((BLOCKS, 1 << BLOCK_BITS, -(-len(items) // 8)), np.uint8)
        for k, mark in enumerate(marks):
            for b in range(BLOCKS):
                near = ((mark >> np.uint64(b * BLOCK_BITS)) & np.uint64(0xFFFF)) ^ _MASKS
                self.table[b, near.astype(np.int64), k >> 3] |= np.uint8(1 << (k & 7))

    def within_radius(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which mark, which item) of all pairs within the radius."""
        found = np.zeros((len(marks), self.table.shape[2]), np.uint8)
        for b in range(BLOCKS):
            found |= self.table[b, ((marks >> np.uint64(b * BLOCK_BITS)) & np.uint64(0xFFFF)).astype(np.int64)]
        mark, item = np.nonzero(np.unpackbits(found, axis=1, bitorder="little", count=len(self.items)))
        near = np.bitwise_count(marks[mark] ^ self.marks[item]) <= RADIUS
        return mark[near], item[near]


class Benchmark:
    """A slice of the items; ``common`` are the sorted shingles that several items of the whole benchmark have, and how many."""

    def __init__(self, items: tuple[tuple[int | None, str], ...], common: tuple[bytes, bytes]):
        self.common, self.counts = np.frombuffer(common[0], np.uint64), np.frombuffer(common[1], np.int64)
        self.maybe_common = _filter(self.common)
        self.ids, self.sizes, self.sets = [], [], []
        for item_id, text in items:
            words = text.encode().lower().split()
            if words:
                self.ids.append(item_id)
                self.sizes.append(len(words))
                self.sets.append(np.unique(windows(word_hashes(words), SIZE), return_counts=True))
        every = np.concatenate([s for s, _ in self.sets]) if self.sets else np.zeros(0, np.uint64)
        self.keys, self.having = np.unique(every, return_counts=True)
        order = np.argsort(every, kind="stable")
        self.owner = np.repeat(np.arange(len(self.sets)), [len(s) for s, _ in self.sets])[order]
        self.owners = np.split(self.owner, np.cumsum(self.having)[:-1]) if self.sets else []
        self.maybe = _filter(self.keys)
        self.short = sorted({n for n in self.sizes if n < SIZE})
        marks = [fingerprints(s, np.sqrt(self.weight(s)) * c, np.zeros(1, np.int64), len(s))[0] for s, c in self.sets]
        each = [self.weight(s) * c for s, c in self.sets]
        self.weights = np.array([x.sum() for x in each])
        self.parts = np.concatenate([np.zeros(0), *each])[order]  # weight in its item of each of ``owner``
        self.by_size = {n: SameSize(k := [i for i, m in enumerate(self.sizes) if m == n], np.array([marks[i] for i in k], np.uint64))
                        for n in set(self.sizes)}

    def place(self, shingles: np.ndarray) -> np.ndarray:
        """Index of each shingle among the slice's, -1 for the others."""
        return _places(self.keys, self.maybe, shingles)

    def weight(self, shingles: np.ndarray) -> np.ndarray:
        at = _places(self.common, self.maybe_common, shingles)
        out = np.ones(len(shingles))
        out[at >= 0] = 1.0 / self.counts[at[at >= 0]]
        return out

    def similarity(self, own: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a window's shingles and an item's."""
        a, a_n = np.unique(own, return_counts=True)
        b, b_n = self.sets[item]
        both = np.union1d(a, b)
        x, y = np.zeros(len(both)), np.zeros(len(both))
        x[np.searchsorted(both, a)] = a_n
        y[np.searchsorted(both, b)] = b_n
        w = self.weight(both)
        return float((np.minimum(x, y) * w).sum() / (np.maximum(x, y) * w).sum())

    def leaks(self, text: str) -> list[tuple[int | None, float, int, int]]:
        """(item_id, similarity, first word, end) of the best window for each item that leaks into the text."""
        if not self.ids:
            return []
        hashes = word_hashes(text.encode().lower().split())
        best: dict[int, tuple[float, int, int]] = {}
        for size in (SIZE, *self.short):
            shingles = windows(hashes, SIZE) if size == SIZE else self._runs(hashes, size)
            if len(shingles) == 0 or (size == SIZE and len(hashes) < SIZE):
                continue
            at = self.place(shingles)
            hits = np.flatnonzero(at >= 0)
            if not len(hits):
                continue
            sizes = {self.sizes[i] for k in np.unique(at[hits]) for i in self.owners[k]}
            for n in sizes:
                if (n if n < SIZE else SIZE) == size:
                    self._windows(shingles, hits, n, len(hashes), 1 if n < SIZE else n - SIZE + 1, best)
            self._sweep(shingles, hits, np.unique(at[hits]), len(hashes), best)
        if 0 < len(hashes) < SIZE and len(hashes) not in self.short:
            return []
        return sorted(((self.ids[i], s, a, b) for i, (s, a, b) in best.items()), key=lambda x: (x[2], str(x[0])))

    @staticmethod
    def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
        """The hash of every run of fewer than ``SIZE`` words, as a text of just these words has it."""
        return np.concatenate([np.zeros(0, np.uint64), *[windows(hashes[k:k + size], SIZE) for k in range(len(hashes) - size + 1)]])

    def _windows(self, shingles: np.ndarray, hits: np.ndarray, n: int, words: int, width: int, best: dict) -> None:
        width = min(width, len(shingles))  # a shorter document is one window
        last = len(shingles) - width
        touched = np.zeros(last + 2, np.int64)
        np.add.at(touched, np.maximum(hits - width + 1, 0), 1)
        np.add.at(touched, np.minimum(hits, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(touched)[:-1] > 0)
        index = self.by_size[n]
        for k in range(0, len(starts), CHUNK):
            some = starts[k:k + CHUNK]
            low, high = some[0], some[-1] + width
            marks = fingerprints(shingles[low:high], np.sqrt(self.weight(shingles[low:high])), some - low, width)
            for w, i in zip(*index.within_radius(marks)):
                item, start = int(index.items[i]), int(some[w])
                s = self.similarity(shingles[start:start + width], item)
                if 100 * s >= THRESHOLD - 1e-9 and (item not in best or s > best[item][0]):
                    best[item] = (s, start, min(start + n, words))

    def _sweep(self, shingles: np.ndarray, hits: np.ndarray, met: np.ndarray, words: int, best: dict) -> None:
        """The best window of every item that has enough of its weight among the shingles ``met``."""
        ends = np.cumsum(self.having)
        lengths = self.having[met]
        rows = np.repeat(ends[met] - np.cumsum(lengths), lengths) + np.arange(lengths.sum())
        held = np.bincount(self.owner[rows], self.parts[rows], len(self.sets))
        some = np.flatnonzero((held > 0) & (100 * held >= (THRESHOLD - 1e-6) * self.weights))
        if not len(some):
            return
        weights = self.weight(shingles)
        total = np.concatenate([[0], np.cumsum(weights)])
        for item in some.tolist():
            n = self.sizes[item]
            width = min(1 if n < SIZE else n - SIZE + 1, len(shingles))
            own = hits[np.isin(shingles[hits], self.sets[item][0])]
            over = np.zeros(len(shingles) + 1)
            over[own + 1] = weights[own]
            over = np.cumsum(over)
            common = over[width:] - over[:-width]
            most = common / (total[width:] - total[:-width] + self.weights[item] - common)
            starts = np.flatnonzero(100 * most >= THRESHOLD - 1e-6)
            for start in starts[np.argsort(-np.round(most[starts], 9), kind="stable")].tolist():
                s, first, _ = best.get(item, (0.0, 0, 0))
                if most[start] < s - 1e-9:
                    break
                if most[start] < s + 1e-9 and start >= first:
                    continue
                now = self.similarity(shingles[start:start + width], item)
                if 100 * now >= THRESHOLD - 1e-9 and (now > s or now == s and start < first):
                    best[item] = (now, start, min(start + n, words))


@lru_cache(maxsize=4)
def _benchmark(items: tuple[tuple[int | None, str], ...], common: tuple[bytes, bytes]) -> Benchmark:
    return Benchmark(items, common)


def common_shingles(benchmark: DataFrame) -> tuple[bytes, bytes]:
    """The sorted shingles that several items have, and how many items have each."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                yield pd.DataFrame({"shingle": shingle_set(text, SIZE).view(np.int64)})

    rows = (benchmark.select(whole_text().alias("text")).mapInPandas(run, "shingle long")
            .groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").toPandas())
    keys = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order].tobytes(), rows["n"].to_numpy(np.int64)[order].tobytes()


def slices(benchmark: DataFrame) -> list[tuple[tuple[int | None, str], ...]]:
    """The items in parts of about ``SLICE_BYTES`` of text, each small enough to go to every task."""
    items = benchmark.select("item_id", whole_text().alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // SLICE_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [tuple(sorted(((r.item_id, r.text) for r in items.where(part == k).collect()), key=str)) for k in range(n)]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word, end_word of every (document, leaked item)."""
    ship(docs.sparkSession)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(benchmark))

    def one(items: tuple) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            b = _benchmark(items, common.value)
            for batch in batches:
                rows = [(doc_id, *x) for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]) for x in b.leaks(text)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "similarity", "first_word", "end_word"], dtype=object)

        rows = docs.select("doc_id", whole_text().alias("text"))
        return map_frames(rows, run, "doc_id long, item_id long, similarity double, first_word long, end_word long")

    parts = [one(items) for items in slices(benchmark)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents into which no item leaks, unchanged; decided row by row, without a shuffle."""
    ship(docs.sparkSession)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(benchmark))
    for items in slices(benchmark):
        def run(batches: Iterator[pa.RecordBatch], items: tuple = items) -> Iterator[pa.RecordBatch]:
            b = _benchmark(items, common.value)
            for batch in batches:
                yield batch.filter(pa.array([not b.leaks(t or "") for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
