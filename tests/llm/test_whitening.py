"""Whitening against exact arithmetic, and eigenvectors of matrices whose eigenvalues are known."""

from fractions import Fraction

import numpy as np
import pytest

from wardbook.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"


def known(rng, e):
    q = np.linalg.qr(rng.standard_normal((len(e), len(e))))[0]
    a = (q * e) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "e",
    [
        np.arange(1, 33.0), 1.5 ** -np.arange(40.0), np.repeat([5.0, 2.0, 1.0], 7), np.ones(20), np.concatenate([10 + 1e-9 * np.arange(6), np.arange(8)]),
        np.concatenate([[1e6], np.ones(5), 1 + 1e-7 * np.arange(5), [1e-6]]), np.array([3.0]), np.zeros(4), np.concatenate([1 + 1e-4 * np.arange(30), [0, 0, 0]]),
    ],
)
def test_eigen(e):
    a = known(np.random.default_rng(len(e)), e)
    found, x = whitening.eigen(a)
    scale = max(1e-300, np.abs(a).max())
    assert (np.diff(found) <= 0).all()
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * len(e) * scale
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 2e-15 * max(4, len(e) ** 0.5)
    assert np.abs(a @ x - x * found).max() <= 4e-15 * len(e) * scale
    assert (x[np.abs(x).argmax(axis=0), np.arange(len(e))] > 0).all()


def test_eigenvectors_are_better_than_double_precision_solvers():
    """Close eigenvalues turn a double-precision solver's vectors by the error over the gap."""
    rng = np.random.default_rng(3)
    a = known(rng, np.concatenate([1 + 1e-6 * np.arange(4), np.arange(2, 20.0)]))
    found, x = whitening.eigen(a)
    high = x.astype(np.longdouble)
    projected = high.T @ a.astype(np.longdouble) @ high
    off = np.abs(projected - np.diag(np.diag(projected))).max()
    assert float(off) < 1e-15


def plain(rows, most=8):
    """n, sums, covariance (correctly rounded) and deviations, in whole numbers and fractions."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows]
    n, dims = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(dims)]
    off = [[n * r[d] - s[d] for d in range(dims)] for r in x]
    v = np.array([[float(Fraction(sum(o[a] * o[b] for o in off), n**3)) for b in range(dims)] for a in range(dims)])
    return n, s, v, [sum(y * y for y in o) for o in off], np.array([[float(Fraction(y, n)) for y in o] for o in off])


def check(got, rows, tolerance=1e-9):
    n, _, v, deviation, centred = plain(rows)
    e = np.linalg.eigvalsh(v)[::-1]
    k = min(8, int((e > len(v) * 2.3e-16 * e[0]).sum()))
    assert len(got) == n * k and {r.n for r in got} == {n}
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    assert sorted((str(i), d) for i, d in by_row for _ in range(len(by_row[i, d]) // k)) == sorted((str(i), d) for (i, _), d in zip(rows, deviation))
    for c in range(1, k + 1):
        own = [r for r in got if r.component == c]
        assert abs(own[0].explained - e[c - 1] / np.trace(v)) <= 1e-9 * own[0].explained
        assert len({r.explained for r in own}) == 1
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    place = {(i, d): c for (i, _), d, c in zip(rows, deviation, centred)}
    y = np.array([[r.whitened for r in sorted(by_row[key], key=lambda r: r.component)[:k]] for key in by_row if len(by_row[key]) == k])
    c = np.array([place[key] for key in by_row if len(by_row[key]) == k])
    vectors = np.linalg.eigh(v)[1][:, ::-1][:, :k] / np.sqrt(e[:k])
    gaps = np.abs(np.diff(e))
    for j in range(k):
        if min(gaps[j : j + 1].min(initial=np.inf), gaps[j - 1] if j else np.inf) > 1e-3 * e[0]:
            want = c @ vectors[:, j]
            assert min(np.abs(y[:, j] - want).max(), np.abs(y[:, j] + want).max()) < tolerance


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    mixed = rng.standard_normal((12, 12)) * np.linspace(1, 0.05, 12)
    v = (rng.standard_normal((300, 12)) @ mixed / 4).astype(np.float32)
    out = [(i, x.tolist()) for i, x in enumerate(v)]
    return [*out, (None, v[3].tolist()), (5, v[5].tolist()), (5, v[6].tolist())]


def test_query(spark, rows, tmp_path):
    bad = [(900, None), (901, []), (902, [None, *rows[0][1][1:]]), (903, [float("nan"), *rows[0][1][1:]]), (904, [float("inf"), *rows[0][1][1:]]), (None, None)]
    docs = spark.createDataFrame(rows + bad, SCHEMA).repartition(5)
    docs.selectExpr("*", "1 AS n", "'c' AS component").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_embedding_whitening(spark, str(tmp_path))
    assert got.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]
    check(got.collect(), rows)


def test_few_vectors(spark):
    make = lambda rows: whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert make([]) == [] and make([(1, [0.5, 0.25])]) == [] and make([(1, [0.5]), (1, [0.5])]) == []
    two = [(1, [0.5, 0.25, 1.0]), (2, [0.5, 0.75, 1.0])]
    check(make(two), two)
    apart = make([*two, (3, [1.0]), (4, [3.0]), (5, [2.0])])
    assert sorted((r.vec_id, r.n) for r in apart) == [(1, 2), (2, 2), (3, 3), (4, 3), (5, 3)]


def test_large_values_and_sums():
    """Beyond the exact range of doubles products are whole numbers, and deviations Python's."""
    a = np.array([[1 << 40, 3], [5, -(1 << 40)]])
    assert whitening._products(np.array([[1 << 27, 3], [5, 7]])).tolist() == [[(1 << 54) + 25, 3 * (1 << 27) + 35], [3 * (1 << 27) + 35, 58]]
    m = whitening.Model(3, np.array([3, 3]), np.zeros((2, 0)), np.zeros(0))
    assert m.deviations(a) == [None, None]
    assert m.deviations(np.array([[2, 1], [1 << 28, 1]])) == [9, (3 * (1 << 28) - 3) ** 2]


def test_registered_tables(spark):
    got = queries.op13_embedding_whitening(spark, "/root/testdata/sf0.001")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(got.collect(), [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])])
