"""PCA whitening of embeddings from exact integer cross-products.

Entries become integers x.  The covariance is taken over the fit list, each distinct x vector
once.  Tasks shift each dimension of a block of vectors to start at zero, write its bits as bit
planes across the block's rows, 64 rows a word, and count the common bits of every two planes
(AND and popcount): weighted by the planes' places these counts are the exact cross-products of
the shifted dimensions, and the shifts are put back in integers.  A table of at most (d+1)(d+2)/2
sums, bounded by the dimension, reaches the driver, where n * sum(x_a x_b) - S_a S_b is formed in
integers; only this centred matrix is rounded and given to ``eigh``.

Defined results: vectors that are null or hold null or non-finite entries are dropped, unlike
lengths are filled up with zeros; repeated rows are returned each, and count once in the fit;
components without spread (eigenvalue zero up to rounding) have ``whitened`` null, and
``identity_error`` is taken over the others, null if there are none; ``explained`` is null if no
dimension has spread; an empty table, or one of empty vectors, gives no rows.  ``deviation`` is a
decimal of 38 digits, null beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .vectors import filled, integer_vectors, lengths, matrix, parts

#: Bits of a cross-product's weights up to which a block is summed in 64-bit integers (block rows take 13 more).
SAFE_BITS = 24
_DECIMAL = pa.decimal128(38, 0)
_LIMIT = 10 ** 38


def bit_planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of unsigned columns: the planes as words of 64 rows, and each plane's dimension and place.

    Places above a dimension's greatest value have no plane; the last word is filled with zeros.
    """
    rows, d = u.shape
    bits = [int(v).bit_length() for v in u.max(axis=0)]
    width = -(-rows // 64) * 8
    planes, owner, place = [], [], []
    for p in range(max(bits, default=0)):
        dims = np.flatnonzero([b > p for b in bits])
        packed = np.packbits(((u[:, dims] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        planes.append(np.pad(packed, ((0, 0), (0, width - packed.shape[1]))).view(np.uint64))
        owner.append(dims)
        place.append(np.full(len(dims), p))
    if not planes:
        return np.zeros((0, width // 8), np.uint64), np.zeros(0, int), np.zeros(0, int)
    planes, owner, place = np.concatenate(planes), np.concatenate(owner), np.concatenate(place)
    order = np.lexsort((place, owner))
    return planes[order], owner[order], place[order]


def cross_products(x: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of (1, x) times (1, x), as Python integers: entry [0, 0] is the row count."""
    rows, d = x.shape
    low = x.min(axis=0)
    planes, owner, place = bit_planes(x.astype(np.uint64) - low.astype(np.uint64))
    common = np.zeros((len(planes), len(planes)), np.int64)
    for i in range(len(planes)):
        common[i, i:] = np.bitwise_count(planes[i] & planes[i:]).sum(axis=1, dtype=np.int64)
    common += np.triu(common, 1).T
    kind = np.int64 if not len(place) or place.max() < SAFE_BITS else object
    weight = np.array([1 << int(p) for p in place], dtype=kind)
    ones = common.diagonal().astype(kind) * weight
    weighted = common.astype(kind) * weight[:, None] * weight[None, :]
    u2 = np.zeros((d, d), dtype=object)
    u1 = np.zeros(d, dtype=object)
    if len(planes):
        dims, first = np.unique(owner, return_index=True)
        u2[np.ix_(dims, dims)] = np.add.reduceat(np.add.reduceat(weighted, first, axis=0), first, axis=1).astype(object)
        u1[dims] = np.add.reduceat(ones, first).astype(object)
    m = np.array([int(v) for v in low], dtype=object)
    out = np.zeros((d + 1, d + 1), dtype=object)
    out[0, 0] = rows
    out[0, 1:] = out[1:, 0] = u1 + rows * m
    out[1:, 1:] = u2 + np.outer(m, u1) + np.outer(u1, m) + rows * np.outer(m, m)
    return out


def summed(fit: DataFrame, d: int) -> np.ndarray:
    """The cross-products over all rows of ``fit``: partial sums of every task, added up in Spark."""
    at = np.triu_indices(d + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in parts(batch):
                own = cross_products(matrix(part.column(0), d))
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()),
                                   pa.array([Decimal(int(v)) for v in total[at]], _DECIMAL)], ["a", "b", "total"])

    sums = fit.select("x").mapInArrow(run, "a int, b int, total decimal(38,0)").groupBy("a", "b").agg(F.sum("total").alias("total"))
    out = np.zeros((d + 1, d + 1), dtype=object)
    for r in sums.collect():
        out[r.a, r.b] = out[r.b, r.a] = int(r.total)
    return out


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its size, sums, and the leading components."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray        # (d, components)
    values: np.ndarray         # falling eigenvalues
    explained: tuple[float | None, ...]

    def project(self, x: np.ndarray) -> np.ndarray:
        """(x - S/n) on each component over the root of its eigenvalue; NaN where that is zero."""
        mean = np.array([s / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, (x - mean) @ self.vectors / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[Decimal | None]:
        """Exact sum over dimensions of (n*x - S)^2."""
        most = self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max((abs(s) for s in self.sums), default=0)
        kind = np.int64 if most * most * len(self.sums) < 1 << 63 else object
        y = x.astype(kind) * self.n - np.array(self.sums, dtype=kind)
        return [Decimal(int(v)) if int(v) < _LIMIT else None for v in (y * y).sum(axis=1)]


def fitted(products: np.ndarray, components: int) -> Whitening:
    n, sums = int(products[0, 0]), [int(s) for s in products[0, 1:]]
    d = len(sums)
    centred = [[n * int(products[a + 1, b + 1]) - sums[a] * sums[b] for b in range(d)] for a in range(d)]
    square = n * n
    values, vectors = np.linalg.eigh(np.array([[v / square for v in row] for row in centred]))
    values, vectors = values[::-1].copy(), vectors[:, ::-1]
    values[values <= d * np.finfo(float).eps * max(values[0], 0)] = 0
    trace = sum(centred[a][a] for a in range(d)) / square
    k = min(components, d)
    return Whitening(n, tuple(sums), np.ascontiguousarray(vectors[:, :k]), values[:k],
                     tuple(float(v) / trace if trace else None for v in values[:k]))


def _identity_error(fit: DataFrame, w: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured over the rows."""
    d, k = len(w.sums), len(w.values)
    live = [j for j in range(k) if w.values[j] > 0]
    if not live:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                z = w.project(matrix(part.column(0), d))
                yield pa.record_batch([pa.array(z[:, j]) for j in live], [f"w{j}" for j in live])

    rows = fit.select("x").mapInArrow(run, ", ".join(f"w{j} double" for j in live))
    pairs = [(a, b) for a in live for b in live if a <= b]
    got = rows.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(got[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(embeddings: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error of every whole vector and
    leading component; see the module's notes for the cases."""
    spark = embeddings.sparkSession
    ship(spark)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = integer_vectors(embeddings, scale, "vec_id")
    _, least, d = lengths(rows)
    if d == 0:
        return spark.createDataFrame([], schema)
    if least < d:
        rows = rows.withColumn("x", filled("x", d))
    fit = stored(rows.select("x").distinct(), "fit")
    w = fitted(summed(fit, d), components)
    error = _identity_error(fit, w)
    k = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                x = matrix(part.column(1), d)
                m = len(x)
                twice = np.repeat(np.arange(m), k)
                z = w.project(x).ravel()
                yield pa.record_batch([
                    part.column(0).take(pa.array(twice)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n, np.int64)), pa.array(w.deviations(x), _DECIMAL).take(pa.array(twice)),
                    pa.array(z, mask=np.isnan(z)), pa.array(list(w.explained) * m, pa.float64()),
                    pa.array([error] * (m * k), pa.float64())],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, schema)
