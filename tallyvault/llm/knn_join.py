"""Exact top-k by inner product: a Voronoi kNN join.

Vectors are integers.  With M the greatest norm, a data vector x becomes the point
(x, sqrt(M^2 - |x|^2)) and a query q the point (q, 0); then |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so
the highest inner products are the nearest points and the triangle inequality holds.

1. Pivots: data rows in the order of their hashes.  Every data point goes to its nearest pivot's
   cell; cells are laid out by (cell, distance to the pivot) in zones of bounded size, so a zone
   holds a few rings of cells, and a large cell takes many zones.
2. Summaries: rows, least and greatest distance of each ring (one row per zone and pivot), and the
   k+1 least distances in each cell.
3. Bounds: a query is within theta of its k+1 nearest points, by the least upper bounds that
   pivots, the cells' nearest points and the rings' greatest distances give.  A ring may hold
   one of them only if [least, greatest] meets [|q p| - theta, |q p| + theta].
4. Replication: a query goes to the zones with such a ring and to no other.  The queries are
   what is replicated, being the smaller side; each data row moves once.
5. Each zone is solved locally, its queries streaming past it in small groups of one cell: windows
   of the rings' distances cut the rows, exact integer scores choose, and the zones' best meet in a
   window over each query.

Of equal vectors only the k+1 of least id can stand among a query's k best others, so a vector that
fills a third of the table shrinks to k+1 rows before it is moved, already where it is read.

Where the data have no structure (random directions) the bounds exclude little and each query
meets every zone: the work is then that of comparing every query with every row, in blocks.

Defined results: vectors that are null or hold null or non-finite entries take no part, unlike
lengths are filled up with zeros; null ids come after all others in ties; a query excludes its own
row only, not other rows that repeat its id or vector; repeated query rows are answered each; a
query alone in the table has no rows; an empty table gives none.  Scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, shuffle_partitions, stored
from .vectors import filled, integer_vectors, lengths, matrix, parts

SCALE = 256
#: Most pivots, and most vectors of a zone on average: both only move the work between tasks.
PIVOTS = 256
ZONE = 1 << 18
#: Least vectors of a zone while there are more tasks to fill.
SMALL_ZONE = 1 << 12
#: Queries compared together, and rows of a zone compared with them at a time.
GROUP, BLOCK = 256, 1 << 14


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exact: in floats while every partial sum is a whole number they hold, else in 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.sqrt((a.astype(float) ** 2).sum(axis=1).max() * (b.astype(float) ** 2).sum(axis=1).max())) * 1.001
    if bound < 1 << 24 and max(abs(a).max(), abs(b).max()) < 1 << 24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if bound < 1 << 53 and max(abs(a).max(), abs(b).max()) < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if bound >= 1 << 62:
        raise OverflowError("inner products beyond 64 bits")
    return a @ b.T


class Space:
    """The pivots' points and the distances to them."""

    def __init__(self, pivots: np.ndarray, square: float) -> None:
        self.pivots, self.square = pivots, square
        self.height = self._height(pivots)
        #: Rounding of a distance stays far below this.
        self.slack = 1e-6 * (np.sqrt(square) + 1)

    def _height(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square - (x.astype(float) ** 2).sum(axis=1), 0))

    def of_data(self, x: np.ndarray) -> np.ndarray:
        """Distances of data points to the pivots: the same for equal rows, whatever stands around them."""
        near = exact_products(x, self.pivots).astype(float) + np.outer(self._height(x), self.height)
        return np.sqrt(np.maximum(2 * (self.square - near), 0))

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        own = (x.astype(float) ** 2).sum(axis=1)
        return np.sqrt(np.maximum(own[:, None] + self.square - 2 * exact_products(x, self.pivots).astype(float), 0))


class Summary:
    """Rings (zone, cell, rows, least and greatest distance) and the least distances of each cell."""

    def __init__(self, rings: list[tuple], nearest: list[tuple], pivots: int) -> None:
        self.zone, self.cell = (np.array([r[i] for r in rings], np.int64) for i in (0, 1))
        self.rows = np.array([r[2] for r in rings], np.int64)
        self.low, self.high = (np.array([r[i] for r in rings], float) for i in (3, 4))
        self.near_cell = np.array([r[0] for r in nearest], np.int64)
        self.near = np.array([r[1] for r in nearest], float)
        self.pivots = pivots

    def theta(self, d: np.ndarray, k: int) -> np.ndarray:
        """For each row of distances to the pivots: a bound within which ``k`` points lie at least (inf: fewer points)."""
        ones = d[:, self.near_cell] + self.near                # a cell's nearest points, its pivot among them
        rings = d[:, self.cell] + self.high                    # all rows of a ring
        out = np.full(len(d), np.inf)
        if ones.shape[1] >= k:
            out = np.partition(ones, k - 1, axis=1)[:, k - 1]
        order = np.argsort(rings, axis=1)
        reached = np.cumsum(self.rows[order], axis=1) >= k
        some = reached.any(axis=1)
        at = order[np.arange(len(d)), reached.argmax(axis=1)]
        return np.minimum(out, np.where(some, rings[np.arange(len(d)), at], np.inf))

    def needed(self, d: np.ndarray, theta: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, zone) pairs, each once, whose rings may hold a point within ``theta``."""
        near, reach = d[:, self.cell], theta[:, None] + slack
        row, ring = np.nonzero((self.low <= near + reach) & (self.high >= near - reach))
        pairs = np.unique(np.stack([row, self.zone[ring]], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


class Zone:
    """One zone's vectors in the order of (cell, distance), compared with groups of queries."""

    def __init__(self, cell: np.ndarray, distance: np.ndarray, ids: np.ndarray, null: np.ndarray, x: np.ndarray) -> None:
        self.cell, self.distance, self.ids, self.null = cell, distance, ids, null
        small = np.int16 if not x.size or max(-int(x.min()), int(x.max())) < 1 << 15 else np.int64
        self.x = x.astype(small)
        cells, starts = np.unique(cell, return_index=True)
        self.rings = list(zip(cells.tolist(), starts.tolist(), [*starts[1:].tolist(), len(cell)]))

    def _rows(self, d: np.ndarray, theta: np.ndarray, slack: float) -> np.ndarray:
        out = []
        for c, a, b in self.rings:
            low, high = (d[:, c] - theta).min() - slack, (d[:, c] + theta).max() + slack
            own = self.distance[a:b]
            out.append(np.arange(a + np.searchsorted(own, low, "left"), a + np.searchsorted(own, high, "right")))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def best(self, ids: np.ndarray, q: np.ndarray, d: np.ndarray, theta: np.ndarray, slack: float, k: int):
        """(query, score, row) of each query's ``k`` best rows here without its own row; ties to the smaller id."""
        found = [np.zeros(0, np.int64)] * 3
        rows = self._rows(d, theta, slack)
        for at in range(0, len(rows), BLOCK):
            own = rows[at:at + BLOCK]
            s = exact_products(q, self.x[own].astype(np.int64))
            if len(own) > k + 1:
                least = np.partition(s, len(own) - k - 1, axis=1)[:, len(own) - k - 1]
                query, col = np.nonzero(s >= least[:, None])
            else:
                query, col = (a.ravel() for a in np.indices(s.shape))
            new = query, s[query, col].astype(np.int64), own[col]
            found = self._cut(*(np.concatenate([a, b]) for a, b in zip(found, new)), k + 1)
        query, score, row = found
        mine = np.flatnonzero((self.ids[row] == ids[query]) & ~self.null[row])
        mine = mine[(self.x[row[mine]] == q[query[mine]]).all(axis=1)] if len(mine) else mine
        _, first = np.unique(query[mine], return_index=True)
        kept = np.delete(np.arange(len(query)), mine[first])
        return self._cut(query[kept], score[kept], row[kept], k)

    def _cut(self, query, score, row, k):
        order = np.lexsort((self.ids[row], self.null[row], -score, query))
        query, score, row = query[order], score[order], row[order]
        starts = np.searchsorted(query, query, "left")
        keep = np.arange(len(query)) - starts < k
        return query[keep], score[keep], row[keep]


def _long(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 for null) and which are null."""
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_null().to_numpy(zero_copy_only=False)


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query`` (a condition on vec_id) holds, its ``k`` best other rows."""
    spark = embeddings.sparkSession
    ship(spark)
    schema = "query_id long, rank int, vec_id long, score long"
    rows = integer_vectors(embeddings, scale, F.col("vec_id").cast("long").alias("vec_id"))
    n, least, d = lengths(rows)
    if n == 0:
        return spark.createDataFrame([], schema)
    if least < d:
        rows = rows.withColumn("x", filled("x", d))

    copies = Window.partitionBy("x").orderBy(F.col("vec_id").asc_nulls_last())
    data = stored(rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "points")
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    n, greatest = data.agg(F.count(F.lit(1)), F.max(square)).first()
    n_pivots = min(PIVOTS, max(1, int(n ** 0.5) // 4))
    pivots = data.orderBy(F.xxhash64("x"), "x", F.col("vec_id").asc_nulls_last()).limit(n_pivots).select("x").collect()
    space = Space(np.array([r.x for r in pivots], dtype=np.int64).reshape(len(pivots), d), greatest)

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                far = space.of_data(matrix(part.column(1), d))
                cell = far.argmin(axis=1)
                yield pa.record_batch([pa.array(cell, pa.int32()), pa.array(far[np.arange(len(far)), cell]), part.column(0), part.column(1)],
                                      ["cell", "distance", "vec_id", "x"])

    zones = max(-(-n // ZONE), min(shuffle_partitions(spark), -(-n // SMALL_ZONE)))
    in_cells = data.mapInArrow(to_cells, "cell int, distance double, vec_id long, x array<long>")
    # Equal rows have equal cells, distances and ids, so they share a zone.
    zoned = stored(in_cells.repartitionByRange(zones, "cell", "distance", "vec_id").withColumn("zone", F.spark_partition_id()), "zones")

    rings = zoned.groupBy("zone", "cell").agg(F.count(F.lit(1)), F.min("distance"), F.max("distance")).collect()
    nearest = (zoned.select("cell", "distance", F.row_number().over(Window.partitionBy("cell").orderBy("distance")).alias("place"))
               .where(F.col("place") <= k + 1).select("cell", "distance").collect())
    summary = Summary([tuple(r) for r in rings], [tuple(r) for r in nearest], len(pivots))

    queries = (rows.where(is_query).groupBy("vec_id", "x").agg(F.count(F.lit(1)).alias("copies"))
               .withColumn("digest", F.sha2(F.array_join("x", ","), 256)))

    def to_zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 4 * GROUP):
                far = space.of_queries(matrix(part.column(1), d))
                theta = summary.theta(far, k + 1)
                row, zone = summary.needed(far, theta, space.slack)
                part = part.take(pa.array(row))
                yield pa.record_batch([pa.array(zone, pa.int32()), pa.array(far.argmin(axis=1)[row], pa.int32()), pa.array(theta[row]),
                                       *part.columns], ["zone", "cell", "theta", *part.schema.names])

    wanted = queries.select("vec_id", "x", "copies", "digest").mapInArrow(
        to_zones, "zone int, cell int, theta double, vec_id long, x array<long>, copies long, digest string")
    both = (zoned.select("zone", F.lit(0).alias("side"), "cell", "distance", "vec_id", "x", F.lit(0).cast("long").alias("copies"), F.lit("").alias("digest"))
            .unionByName(wanted.select("zone", F.lit(1).alias("side"), "cell", F.col("theta").alias("distance"), "vec_id", "x", "copies", "digest"))
            .repartition("zone").sortWithinPartitions("zone", "side", "cell", "distance"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, zone, waiting = None, None, []
        for batch in batches:
            zones_, sides = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(zones_) != 0) | (np.diff(sides) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if here != zones_[a]:
                    here, zone, waiting = zones_[a], None, []
                if sides[a] == 0:
                    run = batch.slice(a, b - a)
                    waiting.append((run.column(2).to_numpy(), run.column(3).to_numpy(), *_long(run.column(4)), matrix(run.column(5), d)))
                    continue
                if zone is None:
                    zone, waiting = Zone(*(np.concatenate(c) for c in zip(*waiting))), []
                for part in parts(batch.slice(a, b - a), GROUP):
                    q, (ids, _) = matrix(part.column(5), d), _long(part.column(4))
                    query, score, row = zone.best(ids, q, space.of_queries(q), part.column(3).to_numpy(), space.slack, k)
                    at = pa.array(query)
                    yield pa.record_batch([part.column(4).take(at), part.column(7).take(at), part.column(6).take(at),
                                           pa.array(zone.ids[row], mask=zone.null[row]), pa.array(score)],
                                          ["query_id", "digest", "copies", "vec_id", "score"])

    found = both.mapInArrow(solve, "query_id long, digest string, copies long, vec_id long, score long")
    order = Window.partitionBy("query_id", "digest").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return (best.select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
            .drop("copy"))
