"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from hammerline.llm import whitening
from hammerline.llm.queries import QUERIES


def dense(vectors):
    """x, exact deviations, eigenvalues, eigenvectors and trace."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    c = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh(c.T @ c / n)
    return c, deviation, values[::-1], axes[:, ::-1], values.sum()


def check(rows, ids, vectors, wanted=8):
    c, deviation, values, axes, trace = dense(vectors)
    k = min(wanted, int((values > 1e-10 * trace).sum()))
    assert len(rows) == k * len(vectors)
    white = c @ axes[:, :k] / np.sqrt(values[:k])
    got = np.zeros_like(white)
    order = {i: r for r, i in enumerate(ids)}
    for r in rows:
        at = order[r.vec_id]
        assert r.n == len(vectors) and r.deviation == deviation[at]
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-10)
        assert r.identity_error <= 1e-9
        got[at, r.component - 1] = r.whitened
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-8
    assert np.abs(got.T @ got / len(vectors) - np.eye(k)).max() < 1e-9


def test_query_matches_dense_eigenvectors(spark):
    sf = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    result = QUERIES["op12_whitened_embeddings"](spark, sf)
    assert dict(result.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    check(result.collect(), [r.vec_id for r in given], [r.embedding for r in given])


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, n int")


def test_cases(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((60, 30)) * np.linspace(3, 0.01, 30)).tolist()
    vectors[5] = vectors[6]
    rows = [(i, v, "a", 1) for i, v in enumerate(vectors)]
    bad = [None, [], [1.0, None] * 15, [float("nan")] + [0.0] * 29, [float("-inf")] * 30, [1.0] * 29]
    rows += [(100 + i, v, None, None) for i, v in enumerate(bad)]
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 7 * 8 * 30)
    check(whitening.whiten(table(spark, rows)).collect(), range(60), vectors)
    nulls = whitening.whiten(table(spark, [(None, v, "a", 1) for v in vectors])).collect()
    assert len(nulls) == 8 * 60 and {r.vec_id for r in nulls} == {None}


def test_few_dimensions_and_low_rank(spark):
    rng = np.random.default_rng(4)
    narrow = rng.standard_normal((50, 3)).tolist()
    check(whitening.whiten(table(spark, [(i, v, "", 0) for i, v in enumerate(narrow)])).collect(), range(50), narrow)
    # Whole steps of 1/1024 along four directions in sixty dimensions.
    steps = rng.integers(-9, 9, (40, 4)) @ rng.integers(-9, 9, (4, 60)) / 1024
    low = steps.tolist()
    check(whitening.whiten(table(spark, [(i, v, "", 0) for i, v in enumerate(low)])).collect(), range(40), low)


def test_nothing_to_whiten(spark):
    equal = table(spark, [(i, [1.0, 2.0], "", 0) for i in range(5)])
    assert whitening.whiten(equal).count() == 0
    assert whitening.whiten(equal.limit(0)).count() == 0
    assert whitening.whiten(table(spark, [(1, None, "", 0)])).count() == 0


def test_equal_eigenvalues_are_certified(spark):
    axes = [[float(s * (i == d)) for i in range(40)] for d in range(40) for s in (-1, 1)]
    rows = whitening.whiten(table(spark, [(i, v, "", 0) for i, v in enumerate(axes)])).collect()
    assert len(rows) == 8 * 80 and rows[0].identity_error < 1e-9
    assert all(r.explained == pytest.approx(1 / 40, rel=1e-9) for r in rows)


def test_passes_do_not_form_the_covariance_or_gather_rows(spark, monkeypatch):
    sizes = []
    once = whitening._sums

    def watched(blocks, part, dims, kind, size):
        sizes.append(size)
        return once(blocks, part, dims, kind, size)

    monkeypatch.setattr(whitening, "_sums", watched)
    blocks = whitening.pack(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))
    whitening.fit(blocks)
    assert max(sizes) == 64 * (8 + whitening.GUARDS) and len(sizes) < 150


def test_deviations_beyond_a_long():
    x = np.array([[100_000, 100_002], [100_004, 100_000]])
    assert whitening.deviations(x, 2, x.sum(axis=0)) == [20, 20]
    assert whitening.deviations(x, 2, np.array([0, 0])) == [2 * 0 + 4 * (100_000**2 + 100_002**2), 4 * (100_004**2 + 100_000**2)]
    assert whitening.deviations(np.array([[1 << 40], [100_000]]), 1 << 40, np.array([100_000 << 40])) == [None, 0]
