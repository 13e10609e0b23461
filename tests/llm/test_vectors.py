"""The operators on embeddings against plain versions, on the small table and on odd rows."""

import collections
import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

import plain
from tallyvault.llm import knn_join, vector_codes, whitening
from tallyvault.llm import queries as Q
from pyspark.sql import functions as F

INF, NAN = float("inf"), float("nan")
BIG = 1 << 60
FLOOR_DOWN = [-0.001, 0.001, -1.0, 0.5, 2.25, -0.75, 0.0, -0.0]


def odd_rows():
    """Nulls, broken entries, ties, repeated rows and ids, ids that a double can't hold."""
    r = np.random.default_rng(3)
    base = r.normal(size=(60, 8)) * 0.2
    rows = [(int(i), [float(v) for v in base[i]], int(i) % 3) for i in range(60)]
    rows += [(100, FLOOR_DOWN, None), (100, FLOOR_DOWN, None), (100, [float(v) for v in base[1]], 1), (150, FLOOR_DOWN, 7)]
    rows += [(200 + i, [float(v) for v in base[0]], 0) for i in range(9)]
    rows += [(0, [float(v) for v in base[0]], 0), (50, [float(v) for v in base[50]], 1), (50, [float(v) for v in base[50]], 1)]
    rows += [(BIG + 1, [float(v) for v in base[2]], 2), (BIG + 3, [float(v) for v in base[2]], 2), (None, [float(v) for v in base[0]], None)]
    rows += [(300, None, 1), (350, [NAN] + FLOOR_DOWN[1:], 1), (400, [None] + FLOOR_DOWN[1:], 1), (450, [INF] + FLOOR_DOWN[1:], 1)]
    return rows + [(500, [-INF] + FLOOR_DOWN[1:], None)]


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.selectExpr("*", "1 AS x", "2 AS zone", "3 AS cell", "4 AS copies", "5 AS digest", "6 AS code", "7 AS rank").repartition(5)


def whole(rows, scale, multiple=1):
    out = [(i, [math.floor(scale * float(np.float64(c))) for c in v], lab) for i, v, lab in rows
           if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(x) for _, x, _ in out), default=0)
    d = -(-d // multiple) * multiple
    return [(i, x + [0] * (d - len(x)), lab) for i, x, lab in out]


def rows_of(spark, sf=plain.SF):
    return [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]


def last(i):
    return plain.LAST if i is None else i


# ---------------------------------------------------------------- whitening

def plain_whitening(rows, components=4):
    rows = whole(rows, 256)
    fit = sorted({tuple(x) for _, x, _ in rows})
    n, d = len(fit), len(fit[0])
    s = [sum(x[a] for x in fit) for a in range(d)]
    v = [[float(Fraction(sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit), n ** 3)) for b in range(d)] for a in range(d)]
    deviation = collections.Counter((i, sum((n * c - t) ** 2 for c, t in zip(x, s))) for i, x, _ in rows)
    return n, s, np.array(v), deviation


def check_whitening(got, rows, components=4):
    n, s, v, deviation = plain_whitening(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, len(s))
    assert {r.n for r in got} == {n}
    for c in range(1, k + 1):
        own = [r for r in got if r.component == c]
        assert collections.Counter((r.vec_id, int(r.deviation)) for r in own) == deviation
        assert abs(own[0].explained - values[c - 1] / values.sum()) < 1e-9
        expected = sorted((last(i), float((np.array(x) - np.array([t / n for t in s])) @ vectors[:, c - 1] / math.sqrt(values[c - 1])))
                          for i, x, _ in whole(rows, 256))
        found = sorted((last(r.vec_id), r.whitened) for r in own)
        sign = 1 if sum(a[1] * b[1] for a, b in zip(found, expected)) >= 0 else -1
        found = sorted((i, sign * w) for i, w in found)
        assert [i for i, _ in found] == [i for i, _ in expected]
        assert max(abs(a[1] - b[1]) for a, b in zip(found, expected)) < 1e-7
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-9
    assert len(got) == k * sum(deviation.values())


def test_bit_sliced_products_are_exact():
    r = np.random.default_rng(1)
    for x in (r.integers(-150, 150, (1000, 5)), r.integers(-9, 1, (63, 3)), np.zeros((7, 4), np.int64), np.array([[5, -5]]),
              r.integers(-(1 << 62), 1 << 62, (130, 3)), np.array([[-(1 << 63), (1 << 63) - 1], [0, -1]])):
        y = np.array([[1, *(int(v) for v in row)] for row in x], dtype=object)
        assert (whitening.cross_products(x.astype(np.int64)) == y.T @ y).all()


def test_op11_on_whole_table_and_odd_rows(spark):
    got = Q.op11_embedding_whitening(spark, plain.SF)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes)["deviation"] == "bigint"
    check_whitening(got.collect(), rows_of(spark))
    check_whitening(whitening.whiten(table(spark, odd_rows())).collect(), odd_rows())


def test_op11_cases_without_spread(spark):
    assert whitening.whiten(table(spark, odd_rows()).limit(0)).count() == 0
    assert whitening.whiten(table(spark, [(1, None, 1), (2, [], 1)])).count() == 0
    got = whitening.whiten(table(spark, [(1, [0.5, 0.25], 1), (1, [0.5, 0.25], 1)])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, None)] * 4
    got = whitening.whiten(table(spark, [(1, [0.5], 1), (2, [0.5, 1.0], 1), (3, [0.5, -1.0, 0.0], 1)])).collect()
    assert len(got) == 9 and {r.component for r in got if r.whitened is not None} == {1}
    assert {r.explained for r in got if r.component == 1} == {1.0} and all(r.identity_error < 1e-9 for r in got)
    huge = whitening.whiten(table(spark, [(1, [1e15, 0.0], 1), (2, [-1e15, 1.0], 1)])).collect()
    assert {int(r.deviation) for r in huge} == {4 * (256 * 10 ** 15) ** 2 + 256 ** 2}


# ---------------------------------------------------------------- top-k

def plain_top(rows, k, wanted):
    rows = whole(rows, 256)
    x = np.array([v for _, v, _ in rows], dtype=np.int64).reshape(len(rows), -1)
    out = []
    for at, (i, _, _) in enumerate(rows):
        if i is not None and wanted(i):
            s = x @ x[at]
            others = sorted((j for j in range(len(rows)) if j != at), key=lambda j: (-s[j], rows[j][0] is None, last(rows[j][0])))
            out += [(i, rank + 1, rows[j][0], int(s[j])) for rank, j in enumerate(others[:k])]
    return sorted(out, key=str)


def test_op12_on_whole_table_and_odd_rows(spark):
    got = Q.op12_exact_top_k(spark, plain.SF)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == plain_top(rows_of(spark), 5, lambda i: i % 50 == 0)
    odd = odd_rows()
    for k in (1, 3, 200):
        got = knn_join.top_k(table(spark, odd), F.col("vec_id") % 50 == 0, k)
        assert sorted(map(tuple, got.collect()), key=str) == plain_top(odd, k, lambda i: i % 50 == 0)
    got = knn_join.top_k(table(spark, odd), F.col("vec_id") > BIG, 4)
    assert sorted(map(tuple, got.collect()), key=str) == plain_top(odd, 4, lambda i: i > BIG)
    assert knn_join.top_k(table(spark, odd).limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert knn_join.top_k(table(spark, [(50, [1.0], 1)]), F.col("vec_id") % 50 == 0).count() == 0
    lone = [(50, [], 1), (51, [1.0], 1), (100, [1.0, -2.0], 1)]
    assert sorted(map(tuple, knn_join.top_k(table(spark, lone), F.col("vec_id") % 50 == 0).collect())) == [
        (50, 1, 51, 0), (50, 2, 100, 0), (100, 1, 51, 256 * 256), (100, 2, 50, 0)]


@pytest.mark.parametrize("shape", ["clusters", "hot", "even"])
def test_op12_over_many_zones(spark, monkeypatch, shape):
    """Small zones and blocks: every bound decides something, and nothing is lost."""
    monkeypatch.setattr(knn_join, "SMALL_ZONE", 64)
    r = np.random.default_rng(7)
    n = 1500
    if shape == "even":
        v = r.normal(size=(n, 6))
    else:
        v = (r.normal(size=(12, 6)) * 3)[r.integers(0, 12, n)] + r.normal(size=(n, 6)) * 0.05
    if shape == "hot":
        v[r.permutation(n)[:n // 3]] = v[0]
    rows = [(int(i), [float(c) for c in v[i]], 0) for i in range(n)]
    got = knn_join.top_k(table(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == plain_top(rows, 5, lambda i: i % 50 == 0)


def test_bounds_exclude_far_rings_and_keep_near_ones():
    r = np.random.default_rng(5)
    centres = r.normal(size=(20, 16)) * 400
    data = np.rint(centres[r.integers(0, 20, 4000)] + r.normal(size=(4000, 16)) * 4).astype(np.int64)
    space = knn_join.Space(data[:40], float((data.astype(float) ** 2).sum(axis=1).max()))
    far = space.of_data(data)
    cell, near = far.argmin(axis=1), far.min(axis=1)
    rings = [(c, c, int((cell == c).sum()), near[cell == c].min(), near[cell == c].max()) for c in np.unique(cell)]
    nearest = [(c, v) for c in np.unique(cell) for v in np.sort(near[cell == c])[:6]]
    summary = knn_join.Summary(rings, nearest, 40)
    d = space.of_queries(data[:200])
    theta = summary.theta(d, 6)
    row, zone = summary.needed(d, theta, space.slack)
    assert len(row) < 0.5 * 200 * len(rings)
    meets = set(zip(row.tolist(), zone.tolist()))
    for q in range(200):
        assert all((q, int(cell[j])) in meets for j in np.argsort(-(data @ data[q]), kind="stable")[:6])


def test_products_are_exact_at_every_size():
    r = np.random.default_rng(9)
    for size in (1 << 8, 1 << 20, 1 << 29):
        a, b = r.integers(-size, size, (9, 5)), r.integers(-size, size, (4, 5))
        assert (knn_join.exact_products(a, b).astype(object) == a.astype(object) @ b.astype(object).T).all()
    with pytest.raises(OverflowError):
        knn_join.exact_products(np.array([[1 << 40]]), np.array([[1 << 40]]))


# ---------------------------------------------------------------- codes

def plain_codes(rows):
    rows = whole(rows, 4096, 8)
    d = len(rows[0][1]) // 8
    cut = [[x[p * d:(p + 1) * d] for p in range(8)] for _, x, _ in rows]
    first = sorted(range(len(rows)), key=lambda j: (rows[j][0] is None, last(rows[j][0]), rows[j][1]))[:16]
    books = [[cut[j][p] for j in first] for p in range(8)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), at) for at, e in enumerate(books[p]))

    for _ in range(6):
        new = []
        for p in range(8):
            members = collections.defaultdict(list)
            for c in cut:
                members[nearest(p, c[p])[1]].append(c[p])
            new.append([[sum(v) // len(members[at]) for v in zip(*members[at])] if members[at] else e for at, e in enumerate(books[p])])
        books = new
    final = [[nearest(p, c[p]) for p in range(8)] for c in cut]
    errors = [sum(e for e, _ in f) for f in final]
    of_label = collections.Counter()
    for (_, _, label), e in zip(rows, errors):
        of_label[label] += e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{at:02x}" for _, at in f), e, of_label[label], digest)
                   for (i, _, label), f, e in zip(rows, final, errors)), key=str)


def test_op13_on_whole_table_and_odd_rows(spark):
    got = Q.op13_vector_codes(spark, plain.SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    cols = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == plain_codes(rows_of(spark))
    for rows in (odd_rows(), odd_rows()[:9], [(3, [1.5] * 9, None), (1, [0.25], 1), (1, [-0.25, 7.0], 1), (None, [0.0], None)],
                 [(1, [1e6] * 8, 1), (2, [-1e6] * 8, 1), (3, [0.1] * 8, 2)]):
        got = vector_codes.compress(table(spark, rows)).select(*cols)
        assert sorted(map(tuple, got.collect()), key=str) == plain_codes(rows)
    assert vector_codes.compress(table(spark, odd_rows()).limit(0)).count() == 0
    assert [(r.code, r.error) for r in vector_codes.compress(table(spark, [(1, [], 1)])).collect()] == [("00" * 8, 0)]


def test_memoised_cells_give_the_nearest_entry_and_leave_entries_out():
    r = np.random.default_rng(2)
    book = r.integers(-2000, 2000, (16, 4))
    x = r.integers(-2500, 2500, (6000, 4))
    x[::7] = book[r.integers(0, 16, len(x[::7]))]
    d = ((x[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    for width in (None, 100, 1):
        for cells in (50, 1 << 16):
            memo = vector_codes.Nearest(book, cells, width)
            for at in range(0, len(x), 1000):
                code, best = memo.assign(x[at:at + 1000])
                assert (code == d[at:at + 1000].argmin(axis=1)).all() and (best == d[at:at + 1000].min(axis=1)).all()
            assert memo.evaluated < 12 * memo.asked
    memo = vector_codes.Nearest(book, width=500)
    memo._hash = lambda cell: np.zeros(len(cell), np.uint64)      # every cell's hash clashes
    assert (memo.assign(x)[0] == d.argmin(axis=1)).all()
