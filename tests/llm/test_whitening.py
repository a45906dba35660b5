"""Whitening against a plain eigendecomposition with exact sums, and on odd rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from rillflow.llm import queries_search, whitening
from rillflow.sources.tables import table


def brute(rows, k=4):
    """(id, n, deviation) of each vector, eigenvalues' shares, and the plain whitened coordinates up to sign."""
    grid = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows]
    fit = sorted({x for _, x in grid})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)] for x in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = []
    for i, x in grid:
        v = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)])
        out.append((i, n, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)), v @ axes[:, :k] / np.sqrt(values[:k])))
    return out, values / values.sum()


def test_query_equals_an_eigendecomposition(spark, sf):
    got = queries_search.op11_whitening(spark, sf).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    want, shares = brute(rows)
    assert len(got) == 4 * len(rows) and [f.dataType.simpleString() for f in queries_search.op11_whitening(spark, sf).schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    signs = {}
    by = {(r["vec_id"], r["component"]): r for r in got}
    for i, n, apart, w in want:
        for c in range(4):
            r = by[i, c + 1]
            assert (r["n"], r["deviation"]) == (n, apart) and abs(r["explained"] / shares[c] - 1) < 1e-9 and r["identity_error"] < 1e-12
            sign = signs.setdefault(c, math.copysign(1, r["whitened"] * w[c]))
            assert r["whitened"] == pytest.approx(sign * w[c], abs=1e-8)


@pytest.mark.parametrize("shape", [(1, 1), (3, 7), (40, 5), (300, 33)])
def test_rotations_give_singular_values_to_the_last_digits(shape):
    rng = np.random.default_rng(1)
    a = rng.normal(size=shape) * 10.0 ** rng.integers(-6, 7, shape[1])  # columns of very different lengths
    r = whitening.triangle(a[k : k + 7] for k in range(0, shape[0], 7))
    sigma, v = whitening.jacobi(r)
    assert np.allclose(v.T @ v, np.eye(shape[1]), atol=1e-13)
    u, want, _ = np.linalg.svd(a)
    assert np.allclose(sigma[: min(shape)], want, rtol=1e-9, atol=1e-12 * want[0]) and np.allclose(np.linalg.norm(a @ v, axis=0), sigma, rtol=1e-9, atol=1e-12 * want[0])


def test_small_deviations_are_accurate():
    """A column of deviation 1e-9 beside one of 1e9: products of columns would lose it, rotations don't."""
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(500, 3)))[0]
    sigma, _ = whitening.jacobi(whitening.triangle([q * [1e9, 1.0, 1e-9]]))
    assert np.allclose(sigma, [1e9, 1.0, 1e-9], rtol=1e-12)


def test_triangles_meet_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(13)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whitened(frame, k=6).collect()}
    want, shares = brute(rows, 6)
    for i, _, apart, w in want:
        assert all(abs(abs(got[i, c + 1]["whitened"]) - abs(w[c])) < 1e-8 and got[i, c + 1]["deviation"] == apart for c in range(6))
    assert sum(got[0, c]["explained"] for c in range(1, 7)) == pytest.approx(1)


def test_odd_rows(spark):
    """Null, empty, short, non-finite; repeats and null ids; other columns with the names of the result."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0], "a"), (1, [0.5, 1.0], "b"), (None, [0.5, 1.0], "c"), (2, [0.25, -3.0], "d"), (3, None, "e"), (4, [], "f"), (5, [1.0], "g"), (6, [nan, 1.0], "h"), (7, [inf, 1.0], "i"), (8, [None, 1.0], "j"), (9, [0.0, 0.0], "k")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string").withColumn("n", F_lit("x")).withColumn("whitened", F_lit("y"))
    got = whitening.whitened(frame).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (9, 1), (9, 2)]
    want, _ = brute([(i, v) for i, v, _ in rows if i in (None, 1, 2, 9)], 2)
    assert {r["n"] for r in got} == {3} and {(r["vec_id"], r["deviation"]) for r in got} == {(i, d) for i, _, d, _ in want}
    assert whitening.whitened(frame.limit(0)).collect() == [] and whitening.whitened(frame.where("vec_id in (3, 4)")).collect() == []
    alike = whitening.whitened(frame.where("vec_id = 1")).collect()
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alike} == {(1, 0, None, None, None)}


def test_a_long_hot_vector_and_large_numbers(spark):
    """A third of all rows alike, 200 dimensions, and entries whose squares no long can hold."""
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in (np.ones(200) if k % 3 else rng.normal(size=200))]) for k in range(60)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=2).collect()
    assert {r["n"] for r in got} == {21} and max(r["identity_error"] for r in got) < 1e-9
    large = [(k, [float(k << 40), 1.0]) for k in range(4)]
    got = whitening.whitened(spark.createDataFrame(large, "vec_id long, embedding array<double>"), k=1).collect()
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == {(i, d) for i, _, d, _ in brute(large, 1)[0]}


def F_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)
