import numpy as np
import pytest

from queuelog.llm import whitening

COLUMNS = "vec_id bigint, embedding array<double>, label int, v int, component string, n bigint"


def brute(vectors, scale=1024, offset=100_000, k=8):
    x = np.floor(scale * np.array(vectors, float)) + offset
    n, s = len(x), [sum(int(c) for c in col) for col in x.T]
    d = x - np.array(s, float) / n
    e, u = np.linalg.eigh(d.T @ d / n)
    e, u = e[::-1], u[:, ::-1]
    dev = [sum((n * int(c) - t) ** 2 for c, t in zip(row, s)) for row in x]
    return n, dev, d @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def as_rows(vectors, ids=None):
    return [(i, v, 1, 2, "c", 3) for i, v in zip(ids or range(len(vectors)), vectors)]


@pytest.mark.parametrize("n, dim", [(300, 12), (40, 64), (5, 3)])
def test_against_eigh(spark, n, dim):
    r = np.random.default_rng(n)
    vectors = (r.normal(size=(n, dim)) * np.linspace(0.3, 1, dim) + 2).tolist()
    got = sorted(whitening.whitened(spark.createDataFrame(as_rows(vectors), COLUMNS).repartition(5)).collect())
    n_, dev, w, explained = brute(vectors)
    k = min(8, dim, n - 1)
    assert len(got) == n * k and {g.n for g in got} == {n_}
    assert [g.deviation for g in got[::k]] == dev
    mine = np.array([g.whitened for g in got]).reshape(n, k)
    for j in range(k):
        sign = np.sign(mine[:, j] @ w[:, j])
        assert np.allclose(sign * mine[:, j], w[:, j], atol=1e-7)
    assert np.allclose([g.explained for g in got[:k]], explained[:k], rtol=1e-9)
    assert max(g.identity_error for g in got) < 1e-9


def test_odd_vectors_take_no_part(spark):
    r = np.random.default_rng(0)
    good = r.normal(size=(50, 4)).tolist()
    odd = [None, [1.0, None, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1e300, 0.0, 0.0, 0.0]]
    rows = as_rows(good) + as_rows(odd, [100, 101, 102, 103, 104]) + [(None, good[0], None, None, None, None), (3, good[3], 1, 2, "c", 3)]
    got = whitening.whitened(spark.createDataFrame(rows, COLUMNS)).collect()
    assert {g.n for g in got} == {52} and len(got) == 52 * 4
    assert {g.vec_id for g in got} == {None, *range(50)}
    short = as_rows([[1.0], [2.0, 5.0], [], [0.5, 1.0]])
    padded = as_rows([[1.0, 0.0], [2.0, 5.0], [0.0, 0.0], [0.5, 1.0]])
    a, b = (sorted(map(tuple, whitening.whitened(spark.createDataFrame(x, COLUMNS)).collect())) for x in (short, padded))
    assert a == b and len(a) == 8


def test_no_variance_no_rows(spark):
    assert whitening.whitened(spark.createDataFrame([], COLUMNS)).count() == 0
    assert whitening.whitened(spark.createDataFrame(as_rows([[], []]), COLUMNS)).count() == 0
    assert whitening.whitened(spark.createDataFrame(as_rows([[1.0, 2.0]] * 5), COLUMNS)).count() == 0
    line = whitening.whitened(spark.createDataFrame(as_rows([[float(i), 2.0 * i] for i in range(9)]), COLUMNS)).collect()
    assert {g.component for g in line} == {1} and abs(line[0].explained - 1) < 1e-12


def test_large_numbers_stay_exact(spark):
    vectors = [[float(2**40 + i), -float(2**41 + 3 * i)] for i in range(8)]
    got = sorted(whitening.whitened(spark.createDataFrame(as_rows(vectors), COLUMNS), scale=1, offset=0).collect())
    ones = sorted(whitening.whitened(spark.createDataFrame(as_rows([[float(i), -3.0 * i] for i in range(8)]), COLUMNS), scale=1, offset=0).collect())
    assert [g.deviation for g in got] == [g.deviation for g in ones]
    assert np.allclose([g.whitened for g in got], [g.whitened for g in ones])
    assert whitening.Whitening(4, [0], np.ones(1), np.ones((1, 1)), 1.0, 1, 0).deviations(np.array([[2.0**45]])) == [None]


def test_factor_and_rotations():
    r = np.random.default_rng(2)
    for n, rank in ((1, 1), (7, 7), (10, 4), (33, 20)):
        b = r.normal(size=(n, rank))
        a = b @ b.T
        order, l = whitening.pivoted_cholesky(a)
        assert l.shape == (n, rank) and np.allclose(l @ l.T, a[order][:, order])
        assert np.allclose(np.triu(l, 1), 0) and (np.diff(np.diag(l)) <= 1e-9).all()
        e, u = whitening.eigen(a)
        assert np.allclose(e, np.linalg.eigvalsh(a)[::-1][:rank]) and np.allclose(u.T @ u, np.eye(rank))
        assert np.allclose(a @ u, u * e)
