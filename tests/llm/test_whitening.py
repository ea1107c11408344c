"""Embedding whitening against numpy's eigenvectors and exact integers."""

import math

import numpy as np
import pytest

from quarry.llm import whitening
from quarry.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"


def expected(vectors, k=8):
    x = np.floor(np.array(vectors, float) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    y = n * x - s  # n times the centred values, exact
    deviation = (y.astype(object) ** 2).sum(1)
    c = y / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, deviation, c @ q / np.sqrt(e), e / np.trace(v)


def check(rows, vectors, k=8):
    n, deviation, white, explained = expected(vectors, k)
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(by) == len(rows) == n * k
    got = np.array([[by[i, j + 1].whitened for j in range(k)] for i in range(n)])
    got *= np.sign((got * white).sum(0))
    assert np.abs(got - white).max() < 1e-9
    for (i, j), r in by.items():
        assert r.n == n and r.deviation == deviation[i] == int(r.deviation_digits)
        assert math.isclose(r.explained, explained[j - 1], rel_tol=1e-9)
        assert r.identity_error == rows[0].identity_error < 1e-9


def test_matches_an_eigensolver_on_the_table(spark):
    table = read_table(spark, SF001, "embeddings")
    ids = [r.vec_id for r in table.orderBy("vec_id").select("vec_id").collect()]
    at = {d: i for i, d in enumerate(ids)}
    vectors = [r.embedding for r in table.orderBy("vec_id").collect()]
    rows = [r.__class__(**(r.asDict() | {"vec_id": at[r.vec_id]})) for r in whitening.whiten(table).collect()]
    check(rows, vectors)


def test_bad_vectors_go_and_odd_rows_stay(spark):
    rng = np.random.default_rng(3)
    good = (rng.normal(size=(40, 5)) * [5, 3, 2, 1, 0.5] + 7).tolist()
    rows = [(i, v, "x") for i, v in enumerate(good)]
    rows += [(50, None, "x"), (51, [1.0, None, 1.0, 1.0, 1.0], "x"), (52, [math.nan] * 5, "x"), (53, [math.inf, 0.0, 0.0, 0.0, 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string").selectExpr("*", "1 as component", "2 as n")
    check(whitening.whiten(df).collect(), good, 5)


def test_short_vectors_continue_with_zeros_and_ids_repeat(spark):
    rows = [(None, [1.0, 2.0]), (None, [3.0]), (7, []), (7, [0.5, -2.0]), (7, [0.5, -2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 10 and {r.n for r in got} == {5}
    _, deviation, _, explained = expected([[1, 2], [3, 0], [0, 0], [0.5, -2], [0.5, -2]], 2)
    assert sorted(r.deviation for r in got) == sorted([*deviation, *deviation])
    assert np.allclose(sorted({r.explained for r in got}, reverse=True), explained)


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 4, [[]] * 3, [None]])
def test_nothing_to_whiten(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    assert whitening.whiten(df).collect() == []


def test_rank_limits_the_components(spark):
    rng = np.random.default_rng(1)
    base = np.floor(rng.normal(size=(30, 2)) * 1000)
    vectors = np.hstack([base, base, np.zeros((30, 1))]) / 1024
    got = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9


def test_deviation_beyond_a_long_keeps_its_digits(spark):
    vectors = [[2.0**30, 1.0], [-(2.0**30), 2.0], [5.0, 3.0], [1e300, 0.0]]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    x = np.array([[min(int(c * 1024) + 100_000, 1 << 50) for c in v] for v in vectors], object)
    want = [int(v) for v in ((4 * x - x.sum(0)) ** 2).sum(1)]
    assert {(r.vec_id, r.deviation_digits) for r in got} == {(i, str(v)) for i, v in enumerate(want)}
    assert {r.deviation for r in got} == {None}


@pytest.mark.parametrize("d", [1, 2, 7, 24])
def test_jacobi_gives_the_singular_values(d):
    rng = np.random.default_rng(d)
    m = rng.normal(size=(3 * d, d)) * np.logspace(0, -6, d)
    e, q = whitening.eigen(m.T @ m)
    want = np.linalg.svd(m, compute_uv=False) ** 2
    assert np.allclose(e, want[: len(e)], rtol=1e-4) and np.abs(q.T @ q - np.eye(len(e))).max() < 1e-12


def test_pivoted_cholesky_stops_at_the_rank():
    rng = np.random.default_rng(0)
    m = rng.normal(size=(9, 3))
    factor, p = whitening.pivoted_cholesky(m @ m.T)
    assert factor.shape == (9, 3) and np.allclose(factor, np.tril(factor))
    assert np.allclose(factor @ factor.T, (m @ m.T)[np.ix_(p, p)])
