"""Whitening against numpy, fractions and plain loops."""

from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from odd_tables import odd, odd_embeddings  # noqa: F401  (fixture)

from seasonlab.llm import whitening as w
from seasonlab.llm.queries import QUERIES


def determinant(m: list[list[Fraction]]) -> Fraction:
    m, out = [r[:] for r in m], Fraction(1)
    for k in range(len(m)):
        at = next((i for i in range(k, len(m)) if m[i][k]), None)
        if at is None:
            return Fraction(0)
        if at != k:
            m[k], m[at], out = m[at], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k])]
    return out


def gram(rng, d: int, rank: int, size: int) -> np.ndarray:
    a = rng.integers(-size, size, (rank, d)).astype(object)
    return a.T @ a


@pytest.mark.parametrize("d,rank,size", [(1, 1, 9), (2, 2, 5), (5, 5, 1000), (6, 3, 10), (7, 9, 1 << 40), (4, 0, 2)])
def test_polynomial_is_exact(spark, d, rank, size):
    m = gram(np.random.default_rng(d), d, rank, size) if rank else np.zeros((d, d), dtype=object)
    got = w.characteristic_polynomial(spark, m)
    for t in range(-2, d):
        want = determinant([[Fraction(t * (i == j) - int(m[i, j])) for j in range(d)] for i in range(d)])
        assert sum(c * t**k for k, c in enumerate(got)) == want


def test_roots_repeats_and_close_ones_are_told_apart():
    def product(roots):
        out = [1]
        for r in roots:
            out = [a - r * b for a, b in zip([0, *out], [*out, 0])]
        return out

    big = 10**30
    found = w.largest_roots(product([big, big - 1, 7, 7, 7, 0, 0]), 4)
    assert [(round(r.decimal()), r.times) for r in found] == [(big, 1), (big - 1, 1), (7, 3)]
    assert w.largest_roots(product([0, 0]), 4) == []
    assert [(round(r.decimal()), r.times) for r in w.largest_roots(product([1, 2, 3, 4, 5]), 2)] == [(5, 1), (4, 1)]
    assert w.roots_above(product([1, 2, 2, 9]), 2, 0) == 1 and w.roots_above(product([1, 2, 2, 9]), 3, 1) == 3


def test_components_of_one_variance_are_orthonormal():
    m = np.diag([9, 9, 9, 4, 1]).astype(object)
    vectors = np.array([[float(a) for a in v] for v in w.null_vectors(m, w.Decimal(9), 3, 60)])
    assert abs(vectors @ vectors.T - np.eye(3)).max() < 1e-15 and abs(vectors[:, 3:]).max() < 1e-15


def test_products_of_large_numbers_are_exact():
    x = np.random.default_rng(1).integers(-(1 << 61), 1 << 61, (50, 3))
    want = x.astype(object).T @ x.astype(object)
    assert (w._products(x) == want).all()
    for value in (0, -1, 1 << 39, -(1 << 39) - 1, 1 << 130, -(1 << 130)):
        assert sum(d * w.PART**k for k, d in enumerate(w._digits(value))) == value


def on_grid(vectors) -> np.ndarray:
    return np.floor(256 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64)


def check(rows, ids: list, x: np.ndarray, most: int = 4) -> None:
    """Rows against numpy's own eigenvectors, up to the sign of a component."""
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T.astype(float), bias=True)
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:most], axes[:, ::-1][:, :most]
    white = (x - sums / n) @ axes / np.sqrt(e)
    deviation = [sum(int(a) ** 2 for a in n * r.astype(object) - sums) for r in x]
    by_component = {k: sorted((r.vec_id or -1, r.deviation, r.whitened) for r in rows if r.component == k) for k in range(1, most + 1)}
    assert Counter(r.component for r in rows) == Counter({k: len(x) for k in range(1, most + 1)})
    for k in range(most):
        want = [sorted(((i or -1), d, s * a) for i, d, a in zip(ids, deviation, white[:, k])) for s in (1, -1)]
        got = by_component[k + 1]
        assert any([g[:2] for g in got] == [t[:2] for t in one] and np.allclose([g[2] for g in got], [t[2] for t in one], atol=1e-9) for one in want)
    assert all(r.n == n and abs(r.explained / (e[r.component - 1] / np.trace(v)) - 1) < 1e-9 and r.identity_error < 1e-9 for r in rows)


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.001"
    ids, vectors = zip(*duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet'").fetchall())
    check(QUERIES["op11_whitening"](spark, sf).collect(), list(ids), on_grid(vectors))


def test_query_on_odd_rows(spark, odd):  # noqa: F811
    fine = [r for r in odd_embeddings() if r["embedding"] and len(r["embedding"]) == 6 and all(v is not None and math.isfinite(v) and abs(v) < 1e9 for v in r["embedding"])]
    check(QUERIES["op11_whitening"](spark, odd).collect(), [r["vec_id"] for r in fine], on_grid([r["embedding"] for r in fine]))


def test_a_hot_vector_counts_once(spark):
    df = spark.range(600).selectExpr("id AS vec_id", "IF(id % 3 = 0, array(1D, 2D, 3D), transform(array(1L, 2L, 3L), k -> CAST(hash(id, k) AS DOUBLE) / 2147483648)) AS embedding")
    ids, vectors = zip(*[tuple(r) for r in df.collect()])
    x = np.floor(256 * np.array(vectors)).astype(np.int64)
    check(w.whiten(df, components=3).collect(), list(ids), x, 3)


def test_large_grids_stay_exact(spark, rows):
    rng = np.random.default_rng(4)
    vectors = rng.integers(-(1 << 50), 1 << 50, (40, 3)).astype(float)
    got = w.whiten(rows([(i, [float(a) for a in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"), components=2).collect()
    assert {r.deviation for r in got} == {None} and all(r.identity_error < 1e-9 for r in got)
    n, sums, scatter = w.scatter_of(w.on_grid(rows([(i, [float(a) for a in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"), "embedding", 256).select("_x"))
    x = np.floor(256 * vectors).astype(np.int64).astype(object)
    assert n == 40 and sums == list(x.sum(axis=0)) and (scatter == 40 * x.T @ x - np.outer(x.sum(axis=0), x.sum(axis=0))).all()


def test_what_does_not_vary(spark, rows):
    one = w.whiten(rows([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in one) == [(i, k, 1, 0, None, None, None) for i in (1, 2) for k in (1, 2)]
    line = w.whiten(rows([(1, [1.0, 2.0]), (2, [3.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    got = {(r.vec_id, r.component): r for r in line}
    assert got[1, 1].whitened == -got[2, 1].whitened and abs(abs(got[1, 1].whitened) - 1) < 1e-12 and got[1, 1].explained == 1
    assert got[1, 2].whitened is None and got[1, 2].explained == 0 and got[1, 2].identity_error < 1e-12
