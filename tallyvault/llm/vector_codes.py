"""Product codes of embeddings: eight codebooks of sixteen entries, fitted in rounds on all rows.

The nearest entry of a part is found through memoised grid cells.  The part's coarse cell is its
coordinates divided by the grid's width; the cell's hash looks up the entries that can be nearest
to any point of the cell's box: an entry is left out if even its least distance to the box is
above the greatest distance of some other entry.  Only the entries left are evaluated exactly, in
integers.  A hash that stands for another cell is told by the cell's stored coordinates, and such
parts are evaluated against all entries.  Each task keeps one memo per codebook of bounded size;
each round sends only per-entry sums and counts (16 x length, whatever the number of rows) through
Spark's aggregation to the driver.

Defined results: vectors that are null or hold null or non-finite entries are dropped; unlike
lengths, and lengths that eight doesn't divide, are filled up with zeros; null ids come last when
the first sixteen are chosen, rows that repeat an id in the order of their vectors; with fewer
than sixteen rows the codebooks have as many entries as there are rows; repeated rows are returned
each; empty vectors have code 0 and error 0; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .vectors import filled, integer_vectors, lengths, matrix, parts

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Grid cells along the spread of a codebook's entries.  Wider cells repeat more and rule out less; only the cost depends on it.
GRID = 6
#: Cells that a memo holds before it starts anew.
CELLS = 1 << 16
#: Above this size squared distances no longer fit 64-bit integers; such parts are evaluated as Python integers.
SAFE = 1 << 28


class Nearest:
    """Nearest entry of one codebook (entries x length, integers), through memoised cells."""

    def __init__(self, book: np.ndarray, cells: int = CELLS, width: int | None = None) -> None:
        self.book, self.cells = book, cells
        spread = int(book.max(initial=0)) - int(book.min(initial=0))
        self.width = width or max(1, spread // GRID)
        self.evaluated = self.asked = 0
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.coordinates = np.zeros((0, self.book.shape[1]), np.int64)
        self.masks = np.zeros(0, np.uint32)

    def _hash(self, cell: np.ndarray) -> np.ndarray:
        h = np.zeros(len(cell), np.uint64)
        for j in range(cell.shape[1]):
            h = (h ^ cell[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def _undominated(self, cell: np.ndarray) -> np.ndarray:
        """Bit mask per cell of the entries that no other entry beats all over the cell's box."""
        low = (cell * self.width)[:, None, :]
        high = low + (self.width - 1)
        book = self.book[None, :, :]
        least = np.maximum(np.maximum(low - book, book - high), 0)
        most = np.maximum(np.abs(book - low), np.abs(book - high))
        least, most = (least * least).sum(axis=2), (most * most).sum(axis=2)
        keep = least <= most.min(axis=1)[:, None]
        return (keep * (np.uint32(1) << np.arange(len(self.book), dtype=np.uint32))).sum(axis=1, dtype=np.uint32)

    def _candidates(self, x: np.ndarray) -> np.ndarray:
        cell = np.floor_divide(x, self.width)
        h = self._hash(cell)
        unique, first, back = np.unique(h, return_index=True, return_inverse=True)
        new = ~np.isin(unique, self.hashes)
        if new.any():
            if len(self.hashes) + new.sum() > self.cells:
                self._forget()
                new[:] = True
            fresh = cell[first[new]]
            hashes = np.concatenate([self.hashes, unique[new]])
            order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[order]
            self.coordinates = np.concatenate([self.coordinates, fresh])[order]
            self.masks = np.concatenate([self.masks, self._undominated(fresh)])[order]
        at = np.searchsorted(self.hashes, unique)[back]
        same = (self.coordinates[at] == cell).all(axis=1)
        return np.where(same, self.masks[at], np.uint32((1 << len(self.book)) - 1))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lower) and the squared distance, exact."""
        size = max(abs(int(v)) for a in (x, self.book) for v in (a.min(initial=0), a.max(initial=0)))
        if size >= SAFE:
            d = ((x.astype(object)[:, None, :] - self.book.astype(object)[None, :, :]) ** 2).sum(axis=2)
            code = np.array([min(range(len(row)), key=row.__getitem__) for row in d], dtype=np.int64)
            return code, d[np.arange(len(d)), code]
        masks = self._candidates(x)
        code, best = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        for e in range(len(self.book)):
            rows = np.flatnonzero(masks >> np.uint32(e) & np.uint32(1))
            diff = x[rows] - self.book[e]
            d = np.einsum("ij,ij->i", diff, diff)
            nearer = d < best[rows]
            code[rows[nearer]], best[rows[nearer]] = e, d[nearer]
            self.evaluated += len(rows)
        self.asked += len(x)
        return code, best


def _pieces(x: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(x, PARTS, axis=1)]


def _round(rows: DataFrame, books: list[np.ndarray], d: int) -> list[np.ndarray]:
    """The codebooks after one round: floors of the means of the parts at each entry."""
    entries, length = books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [Nearest(b) for b in books]
        sums = np.zeros((PARTS, entries, length + 1), dtype=object)   # the last place counts
        for batch in batches:
            for part in parts(batch):
                for j, x in enumerate(_pieces(matrix(part.column(0), d))):
                    code, _ = memos[j].assign(x)
                    kind = object if len(x) and np.abs(x).max(initial=0) >= SAFE else np.int64
                    for e in np.unique(code):
                        own = x[code == e]
                        sums[j, e, :length] += own.astype(kind).sum(axis=0).astype(object)
                        sums[j, e, length] += len(own)
        p, e, at = (a.ravel() for a in np.indices(sums.shape))
        yield pa.record_batch([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(at, pa.int32()),
                               pa.array([Decimal(int(v)) for v in sums.ravel()], pa.decimal128(38, 0))], ["part", "entry", "at", "total"])

    got = (rows.select("x").mapInArrow(run, "part int, entry int, at int, total decimal(38,0)")
           .groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect())
    total = {(r.part, r.entry, r["at"]): int(r.total) for r in got}
    new = [b.copy() for b in books]
    for j in range(PARTS):
        for e in range(entries):
            if n := total[j, e, length]:
                new[j][e] = [total[j, e, at] // n for at in range(length)]
    return new


def codebooks(rows: DataFrame, d: int) -> list[np.ndarray]:
    """Eight codebooks fitted on all of ``rows`` (vec_id, x of ``d`` entries)."""
    first = rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).collect()
    books = _pieces(np.array([r.x for r in first], dtype=np.int64).reshape(len(first), d))
    for _ in range(ROUNDS):
        books = _round(rows, books, d)
    return books


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compress(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every whole vector."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = integer_vectors(embeddings, SCALE, "vec_id", "label")
    n, least, most = lengths(rows)
    if n == 0:
        return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")))
    d = -(-most // PARTS) * PARTS
    if least < d:
        rows = rows.withColumn("x", filled("x", d))
    rows = stored(rows.withColumn("vec_id", F.col("vec_id").cast("long")), "vectors")
    books = codebooks(rows, d)
    label = next(f for f in rows.schema.fields if f.name == "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [Nearest(b) for b in books]
        for batch in batches:
            for part in parts(batch):
                x = matrix(part.column(2), d)
                found = [memo.assign(p) for memo, p in zip(memos, _pieces(x))]
                code = np.stack([c for c, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                error = sum(e for _, e in found)
                width = 2 * PARTS
                yield pa.record_batch([part.column(0), part.column(1),
                                       pa.array([code[at:at + width] for at in range(0, len(code), width)], pa.string()),
                                       pa.array([int(e) for e in error], pa.int64())], ["vec_id", "label", "code", "error"])

    schema = f"vec_id long, label {label.dataType.simpleString()}, code string, error long"
    coded = stored(rows.select("vec_id", "label", "x").mapInArrow(run, schema), "codes")
    of_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(of_label, F.col("label").eqNullSafe(F.col("of_label")))
            .select("vec_id", "label", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")))
