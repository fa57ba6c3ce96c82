"""Whitening: the eigen solver against known decompositions, the whole against exact and high-precision arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tripmart.llm import catalog, whitening

DDL = "vec_id bigint, embedding array<float>, label int, n string, whitened string"


def basis(size, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(size, dtype=np.longdouble) - 0.5 * (q.T @ q))
    return q


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [2.0, 1.0],
        list(range(1, 41)),
        [5.0] * 10 + [1.0] * 30,
        [5 + 1e-9 * i for i in range(10)] + [1 + 1e-12 * i for i in range(20)],
        [1e6, 1e6 * (1 + 1e-10), *np.linspace(1, 2, 20)],
        [0.0] * 20 + [1.0, 2.0, 3.0],
        [10.0**-i for i in range(30)],
    ],
)
def test_eigen_is_exact_also_for_clusters(values):
    values = np.array(values, np.longdouble)
    q = basis(len(values))
    found, vectors = whitening.eigen((q * values) @ q.T)
    size = np.abs(values).max()
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-17 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-17
    assert np.abs((q * values) @ q.T @ vectors - vectors * found).max() < 1e-16 * size


def test_close_eigenvalues_have_their_own_vectors():
    values = np.array([2, 1 + 1e-8, 1, 0.5], np.longdouble)  # float32 cannot tell the middle ones apart
    q = basis(4)
    _, vectors = whitening.eigen((q * values) @ q.T)
    assert np.abs(np.abs(q.T @ vectors) - np.eye(4)).max() < 1e-10


def test_zero_and_empty_matrices():
    assert whitening.eigen(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert np.abs(whitening.eigen(np.eye(5))[0] - 1).max() == 0


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "x") for i, v in vectors], DDL).repartition(3)


def test_rows_that_cannot_be_used_go(spark):
    good = [(1, [0.1, 0.2]), (2, [0.3, -0.4]), (2, [0.3, -0.4]), (None, [1.0, 0.0])]
    bad = [(5, None), (6, [None, 1.0]), (7, [math.nan, 1.0]), (8, [math.inf, 0.0]), (9, []), (10, [1.0]), (11, [1.0, 2.0, 3.0])]
    rows = whitening.whitened_components(table(spark, good + bad)).collect()
    assert sorted((r.id or 0, r.component) for r in rows) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2), (2, 2)]
    assert {r.n for r in rows} == {4} and {r.identity_error < 1e-9 for r in rows} == {True}


def test_of_lengths_with_as_many_vectors_the_larger_counts(spark):
    rows = whitening.whitened_components(table(spark, [(1, [1.0]), (2, [2.0]), (3, [1.0, 2.0]), (4, [2.0, 1.0])])).collect()
    assert {r.id for r in rows} == {3, 4}


def test_equal_rows_single_rows_and_no_rows_have_no_components(spark):
    for vectors in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened_components(table(spark, vectors)).count() == 0


def test_vectors_in_a_plane_have_two_components(spark):
    pick = np.random.default_rng(1).integers(-20, 20, (50, 2)) / 4
    plane = [(i, [float(a), float(b), float(a + b)]) for i, (a, b) in enumerate(pick)]
    rows = whitening.whitened_components(table(spark, plane)).collect()
    assert {r.component for r in rows} == {1, 2} and abs(sum({r.component: r.explained for r in rows}.values()) - 1) < 1e-12


def test_values_of_very_different_size(spark):
    rows = whitening.whitened_components(table(spark, [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [5.0, -1e9])])).collect()
    assert {r.id for r in rows} == {1, 2, 3} and all(r.identity_error < 1e-4 for r in rows)
    assert {r.deviation for r in rows if r.id == 1} == {None}


def test_query_against_exact_covariance(spark, sf_dir):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    ids = sorted(i for i, v in vectors.items() if v is not None and all(x is not None and math.isfinite(x) for x in v))
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in vectors[i]] for i in ids], object)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums
    exact = centred.T @ centred  # n^3 times the covariance
    covariance = np.array([[float(Fraction(int(v), n**3)) for v in row] for row in exact])
    values, basis64 = np.linalg.eigh(covariance)
    rows = catalog.op12_whitened(spark, sf_dir).collect()
    assert len(rows) == 8 * n
    whole = {(r.vec_id, r.component): r for r in rows}
    for k in range(1, 9):
        got = np.array([whole[i, k].whitened for i in ids])
        want = (centred.astype(float) / n) @ basis64[:, -k] / math.sqrt(values[-k])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9
        assert abs(whole[ids[0], k].explained / (values[-k] / np.trace(covariance)) - 1) < 1e-12
    assert all(whole[i, 1].deviation == int((c * c).sum()) for i, c in zip(ids, centred, strict=True))
    assert {r.n for r in rows} == {n} and {r.identity_error < 1e-10 for r in rows} == {True}
