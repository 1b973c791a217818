import math

import numpy as np
import pytest

from sievework.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=16, scale=64.0):
    """Whitened values by numpy's eigenvectors, exact deviations, shares: the fit list is every distinct vector once."""
    kept = [(i, [math.floor(scale * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array(fit, float) - np.array(sums) / n
    w, u = np.linalg.eigh(y.T @ y / n)
    w, u = w[::-1][:k], u[:, ::-1][:, :k]
    out = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), (np.array([n * a - s for a, s in zip(x, sums, strict=True)]) / n) @ u / np.sqrt(w)) for i, x in kept]
    return n, out, w / np.trace(y.T @ y / n)


def matrix(df):
    rows = df.orderBy("vec_id", "component").collect()
    return rows, {i: [r.whitened for r in rows if r.vec_id == i] for i in {r.vec_id for r in rows}}


@pytest.mark.parametrize("d", [1, 5, 24])
def test_against_numpy(spark, d):
    rng = np.random.default_rng(d)
    rows = [(i, (rng.normal(size=d) * np.linspace(3, 0.5, d) + 7).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)]  # copies count once in the fit
    got, by_id = matrix(whitening.whiten(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)))
    n, want, explained = plain(rows)
    k = min(16, d)
    assert len(got) == len(rows) * k and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, k + 1))
    a, b = np.array([by_id[i] for i, _, _ in want]), np.array([z for _, _, z in want])
    assert np.abs(a * np.sign(a[0] * b[0]) - b).max() < 1e-9
    deviation = {r.vec_id: r.deviation for r in got}
    assert [deviation[i] for i, _, _ in want] == [x for _, x, _ in want]
    assert np.allclose([r.explained for r in got[:k]], explained[:k], rtol=1e-10) and got[0].identity_error < 1e-10


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got, by_id = matrix(whitening.whiten(df))
    n, want, explained = plain([(r.vec_id, r.embedding) for r in df.collect()])
    a, b = np.array([by_id[i] for i, _, _ in want]), np.array([z for _, _, z in want])
    assert np.abs(a * np.sign(a[0] * b[0]) - b).max() < 1e-8 and np.allclose([r.explained for r in got[:16]], explained, rtol=1e-10)


def test_factor_and_rotations():
    rng = np.random.default_rng(4)
    for d, rank in [(1, 1), (7, 7), (12, 5), (30, 30)]:
        x = rng.normal(size=(d, rank)) * 10.0 ** np.linspace(0, -4, rank)
        v = x @ x.T
        f = whitening.pivoted_cholesky(v)
        assert f.shape == (d, rank) and np.allclose(f @ f.T, v, atol=1e-14)
        order = np.argsort([next((j for j in range(rank) if row[j]), rank) for row in f != 0], kind="stable")
        g = whitening.orthogonal_columns(f)
        assert np.allclose(g @ g.T, v, atol=1e-14) and len(order) == d
        values, unit = whitening.principal(v)
        assert np.allclose(values, np.linalg.svd(x, compute_uv=False) ** 2, rtol=1e-9) and np.allclose(unit.T @ unit, np.eye(rank), atol=1e-12)


def test_lower_rank_and_large_numbers(spark):
    flat = [(i, [float(i % 5), 2.0 * (i % 5), 1.0], 0) for i in range(20)]
    got, _ = matrix(whitening.whiten(spark.createDataFrame(flat, SCHEMA)))
    assert len(got) == 20 and {r.component for r in got} == {1} and {r.n for r in got} == {5} and abs(got[0].explained - 1) < 1e-12
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(9)], SCHEMA)).count() == 0
    assert whitening.deviations(np.array([[3, -4], [2**31, 2**32]])) == [25, None]
    assert whitening.deviations(np.array([[2**31, 1]])) == [2**62 + 1]


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [3.0, 2.5], None), (None, [0.0, 1.0], 1), (3, None, 1), (4, [], 1), (5, [1.0, None], 1), (6, [float("nan"), 1.0], 1),
        (7, [float("inf"), 1.0], 1), (8, [1.0, 2.0, 3.0], 1), (9, [-3e38, 3e38], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.selectExpr("*", "1 AS v", "2 AS n", "3 AS component", "4 AS _id", "5 AS whitened")
    got = whitening.whiten(extra).collect()
    assert sorted((r.vec_id for r in got), key=str) == [1, 1, 1, 1, 2, 2, 9, 9, None, None] and {r.n for r in got} == {4}
    assert all(math.isfinite(r.whitened) for r in got)
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id IN (3, 4)")).count() == 0
