"""Whitening against exact sums in plain Python and against numpy's eigenvalues."""

import math
from fractions import Fraction

import numpy as np
import pytest

from basketlab.llm import whitening
from basketlab.llm.whitening import largest_roots, polynomial_mod, primes_beyond, remaindered, roots_above, scatter

FOLDER = "/root/testdata/sf0.001"


def usable(vector):
    return vector is not None and len(vector) > 0 and all(v is not None and math.isfinite(v) for v in vector)


def expected(rows):
    """Integers, deviations and covariance of the rows that stay."""
    kept = [(i, [math.floor(64 * v) + 1_000_000 for v in vector]) for i, vector in rows if usable(vector)]
    n = len(kept)
    sums = [sum(x[k] for _, x in kept) for k in range(len(kept[0][1]))]
    deviation = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for _, x in kept])
    return n, deviation, centred


def check(found, rows, wanted=32):
    n, deviation, centred = expected(rows)
    size = centred.shape[1]
    wanted = min(wanted, size)
    assert len(found) == n * wanted and {r["n"] for r in found} == {n}
    key = [(r["vec_id"], r["deviation"]) for r in found if r["component"] == 1]
    assert sorted(key, key=str) == sorted(deviation, key=str)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    shares = {r["component"]: r["explained"] for r in found}
    assert np.allclose([shares[k + 1] for k in range(wanted)], values / np.trace(centred.T @ centred / n), rtol=1e-9, atol=1e-12)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    return values, vectors, centred


def test_query_equals_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = whitening.query(spark, FOLDER).collect()
    values, vectors, centred = check(found, rows)
    want = centred @ vectors / np.sqrt(values)
    place = {i: k for k, (i, v) in enumerate((i, v) for i, v in rows if usable(v))}
    got = np.zeros_like(want)
    for r in found:
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-8


def test_odd_rows_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25, 0.0]), (1, [0.5, -0.25, 0.0]), (None, [1.0, 2.0, -3.0]), (2, None), (3, [None, 1.0, 1.0]), (4, [nan, 0.0, 0.0]),
        (5, [inf, 0.0, 1.0]), (6, [-inf, 0.0, 1.0]), (7, [-0.001, 0.3, 0.7]), (8, [100.0, -50.0, 0.25]), (9, []),
    ]
    df = spark.createDataFrame([(i, v, 1, "x", [0.0]) for i, v in rows], "vec_id long, embedding array<float>, n int, component string, vector array<float>")
    check(whitening.whiten(df).collect(), [(i, None if v is None else [None if e is None else float(np.float32(e)) for e in v]) for i, v in rows])


def test_no_rows_and_no_variance(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty).collect() == []
    same = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, whitening.whiten(same).collect())) == [
        (i, k, 2, 0, None, None, 0.0) for i in (1, 2) for k in (1, 2)]
    line = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], "vec_id long, embedding array<double>")
    found = sorted(map(tuple, whitening.whiten(line).collect()))
    assert [(r[0], r[1], r[3]) for r in found] == [(1, 1, 20480), (1, 2, 20480), (2, 1, 20480), (2, 2, 20480)]
    assert [abs(r[4]) if r[4] is not None else None for r in found] == [pytest.approx(1.0), None, pytest.approx(1.0), None]
    assert [r[5] for r in found] == [1.0, 0.0, 1.0, 0.0]


def test_equal_roots_have_orthogonal_components(spark):
    corners = [(i, [float(s) if k == i // 2 else 0.0 for k in range(6)]) for i, s in enumerate([1, -1] * 6)]
    found = whitening.whiten(spark.createDataFrame(corners, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 12 * 6 and found[0]["identity_error"] < 1e-12
    assert {round(r["explained"], 12) for r in found} == {round(1 / 6, 12)}


def test_errors_are_named(spark):
    uneven = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="different lengths"):
        whitening.whiten(uneven)


def test_scatter_is_exact():
    y = np.random.default_rng(1).integers(-(1 << 45), 1 << 45, (300, 4))
    assert (scatter(y) == y.astype(object).T @ y.astype(object)).all()


def test_polynomial_by_primes_is_exact():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 9):
        half = rng.integers(-10**6, 10**6, (size, size + 2)).astype(object)
        half[0] *= 0 if size == 9 else 1
        matrix = half @ half.T
        # Faddeev-LeVerrier with exact integers.
        want, power = [1], np.zeros((size, size), object)
        for k in range(1, size + 1):
            power = matrix @ power + want[-1] * np.identity(size, int).astype(object)
            want.append(-int((matrix @ power).trace()) // k)
        primes = primes_beyond(max(map(abs, want)))
        residues = {p: [(-c if k % 2 else c) % p for k, c in enumerate(polynomial_mod(matrix, p).tolist())] for p in primes}
        assert [-c if k % 2 else c for k, c in enumerate(remaindered(residues))] == want


def product_of(roots):
    coefficients = [1]
    for r in roots:
        coefficients = [a - r * b for a, b in zip([*coefficients, 0], [0, *coefficients])]
    return coefficients


def test_roots_close_equal_and_zero():
    roots = [10**12, 10**12 - 1, 500, 500, 500, 3, 1, 0, 0]
    coefficients = product_of(roots)
    assert [roots_above(coefficients, a) for a in (1, 2, 499, 500, 10**12 - 1, 10**12)] == [6, 6, 5, 2, 1, 0]
    found, scale = largest_roots(coefficients, 9)
    assert [(Fraction(y, 1 << scale), m) for y, m in found] == [(10**12, 1), (10**12 - 1, 1), (500, 3), (3, 1), (1, 1)]
    found, scale = largest_roots([1, -6, 7], 2)
    assert [y / (1 << scale) for y, _ in found] == pytest.approx([3 + 2**0.5, 3 - 2**0.5], rel=1e-15)
    assert all(abs((Fraction(y, 1 << scale) - 3) ** 2 - 2) < Fraction(1, 1 << 200) for y, _ in found)
