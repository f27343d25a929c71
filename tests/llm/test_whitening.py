"""Exact polynomials, roots and vectors against plain arithmetic, and whitened vectors against numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from backglance.llm import whitening
from backglance.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def exact_polynomial(matrix):
    """Faddeev and LeVerrier's recurrence in whole numbers."""
    d = len(matrix)
    a = np.array(matrix, object)
    m, found = np.zeros((d, d), object), [1]
    for k in range(1, d + 1):
        m = a @ m + found[-1] * np.eye(d, dtype=object).astype(int).astype(object)
        found.append(-sum((a @ m)[i, i] for i in range(d)) // k)
    return found


def gram(rows):
    a = np.array(rows, object)
    return (a.T @ a).tolist()


SMALL = st.integers(2, 6).flatmap(lambda d: st.lists(st.lists(st.integers(-9, 9), min_size=d, max_size=d), min_size=1, max_size=9))


@settings(max_examples=60, deadline=None)
@given(SMALL)
def test_polynomial_modulo(rows):
    matrix, p = gram(rows), 2147483647
    assert whitening.polynomial_modulo(np.array(matrix, np.int64), p) == [c % p for c in exact_polynomial(matrix)]


@pytest.mark.parametrize("scale", [1, 10**9, 10**30])
def test_polynomial_by_remainders(spark, scale):
    draw = np.random.default_rng(3)
    matrix = gram([[int(v) * scale for v in row] for row in draw.integers(-50, 50, (12, 9))])
    assert whitening.characteristic_polynomial(spark, matrix) == exact_polynomial(matrix)


def test_primes():
    found = whitening.primes_beyond(300)
    assert len(set(found)) == len(found) and math.prod(found).bit_length() > 300
    assert all(all(p % q for q in range(2, 1000)) and p < 1 << 31 for p in found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=6), st.integers(0, 4), st.integers(0, 200))
def test_roots(roots, scale, at):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([*poly, 0], [0, *poly])]
    assert whitening.roots_above(poly, at, scale) == sum(r > Fraction(at, 1 << scale) for r in roots)
    once = whitening.distinct_roots(poly)
    distinct = sorted(set(roots), reverse=True)
    assert len(once) - 1 == len(distinct)
    for place, r in enumerate(distinct, 1):
        low, high, s = whitening.isolate(once, place, sum(roots))
        assert Fraction(low, 1 << s) < r <= Fraction(high, 1 << s) and (high - low) / (1 << s) < 1e-15 * r


def check(matrix, spark, n=1):
    """Eigenvalues and vectors of a matrix by the library against numpy's."""
    whole = whitening.characteristic_polynomial(spark, matrix)
    while whole[-1] == 0:
        whole = whole[:-1]
    once = whitening.distinct_roots(whole)
    values, vectors = np.linalg.eigh(np.array(matrix, float))
    top, at = sum(matrix[i][i] for i in range(len(matrix))), len(matrix)
    for place in range(1, len(once)):
        low, high, s = whitening.isolate(once, place, top)
        many = whitening.roots_above(whole, low, s) - whitening.roots_above(whole, high, s)
        found = whitening.null_vectors(matrix, low, high, s, many)
        same = vectors[:, at - many : at]
        assert np.allclose(values[at - many : at], high / (1 << s), rtol=1e-9)
        assert np.allclose(found @ found.T, np.eye(many), atol=1e-14)
        assert np.allclose(found.T @ found, same @ same.T, atol=1e-8)
        residual = np.array(matrix, float) @ found.T - found.T * (high / (1 << s))
        assert np.abs(residual).max() <= 1e-13 * max(top, 1)
        at -= many
    assert np.allclose(values[:at], 0, atol=1e-9 * top)


def test_repeated_and_zero_eigenvalues(spark):
    check([[4, 0, 0], [0, 4, 0], [0, 0, 4]], spark)
    check([[2, 1, 1], [1, 2, 1], [1, 1, 2]], spark)  # 4, 1, 1
    check([[1, 1], [1, 1]], spark)  # 2, 0
    check([[3]], spark)
    draw = np.random.default_rng(8)
    check(gram([[int(v) for v in row] for row in draw.integers(-1000, 1000, (5, 11))]), spark)  # rank 5
    block = gram([[int(v) for v in row] for row in draw.integers(-30, 30, (9, 4))])
    check([[block[i % 4][j % 4] if i // 4 == j // 4 else 0 for j in range(8)] for i in range(8)], spark)  # all twice


def test_close_eigenvalues(spark):
    """Two eigenvalues that differ by 2 in 10^30, where floating point sees one."""
    big = 10**30
    matrix = [[big, 1, 0], [1, big, 0], [0, 0, 7]]
    whole = whitening.characteristic_polynomial(spark, matrix)
    for place, vector in ((1, [1, 1, 0]), (2, [1, -1, 0]), (3, [0, 0, 1])):
        low, high, s = whitening.isolate(whole, place, 2 * big + 7)
        found = whitening.null_vectors(matrix, low, high, s, 1)[0]
        wanted = np.array(vector) / np.linalg.norm(vector)
        assert abs(abs(found @ wanted) - 1) < 1e-15 and np.abs(np.abs(found) - np.abs(wanted)).max() < 1e-15


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**63) + 2**21, 2**63 - 2**21), min_size=3, max_size=3), min_size=1, max_size=5))
def test_products_of_any_longs(rows):
    assert whitening.exact_products(np.array(rows, np.int64)).tolist() == gram(rows)
    for v in rows[0]:
        assert sum(part << (48 * place) for place, part in whitening._parts(v)) == v


def usable(rows):
    return [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def compare(rows, found, components=32, tolerance=1e-9):
    """Rows of (vec_id, vector) against sums in whole numbers and numpy's eigenvectors."""
    rows = usable(rows)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    centred = [[n * a - s for a, s in zip(row, sums)] for row in x]
    cov = np.array(gram(centred), float) / n**3
    values, vectors = np.linalg.eigh(cov)
    rank = int((values > 1e-9 * max(values.max(), 1e-300)).sum())
    many = min(components, rank)
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, []).append(r)
        assert r.n == n and abs(r.identity_error) <= 1e-4
    assert len(found) == n * many
    whitened = np.array([[r.whitened for r in sorted(by_id[k], key=lambda r: r.component)] for k, _ in rows])
    for (k, _), line in zip(rows, centred):
        assert {r.deviation for r in by_id[k]} == {sum(v * v for v in line)}
        assert sorted(r.component for r in by_id[k]) == list(range(1, many + 1))
    wanted = np.array(centred, float) / n @ vectors[:, ::-1][:, :many] / np.sqrt(values[::-1][:many])
    signs = np.sign((wanted * whitened).sum(0))
    assert np.abs(whitened - wanted * signs).max() < tolerance * max(1, np.abs(wanted).max())
    explained = {r.component: r.explained for r in found}
    assert all(abs(explained[i + 1] - values[::-1][i] / np.trace(cov)) < 1e-6 * explained[i + 1] for i in range(many))
    w = whitened - whitened.mean(0)
    assert np.abs(w.T @ w / n - np.eye(many)).max() < 1e-9


def test_query_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(rows, QUERIES["op13_exact_whitening"](spark, SF).collect())


NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_unusable_vectors_are_left_out(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(v) for v in draw.normal(size=5)]) for i in range(20)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [NAN] * 5), (103, [INF, 0.0, 0.0, 0.0, 0.0]), (104, [1e300] * 5)]
    wrong = [(105, []), (106, [1.0]), (107, [1.0] * 7)]
    found = whitening.whiten(frame(spark, [*rows, *bad, *wrong]).withColumns({c: F.lit(1) for c in ("entries", "component", "n", "i")}))
    compare(rows, found.collect())


def test_large_entries_and_copies(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(v) for v in draw.normal(size=3) * 1e9]) for i in range(30)]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert {r.deviation for r in found} == {None} or all(r.deviation is None or r.deviation >= 0 for r in found)
    assert abs(found[0].identity_error) < 1e-6
    some = [(i, [float(v) for v in draw.normal(size=3)]) for i in range(9)]
    copies = some + [(50 + i, some[0][1]) for i in range(200)]
    compare(copies, whitening.whiten(frame(spark, copies)).collect())


def test_no_components(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, [])], [(1, None)]):
        assert whitening.whiten(frame(spark, rows)).count() == 0
    two = whitening.whiten(frame(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (None, [1.0, 1.0])])).collect()
    assert len(two) == 3 and {r.component for r in two} == {1} and {r.explained for r in two} == {1.0}
