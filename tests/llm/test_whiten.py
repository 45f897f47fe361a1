"""Whitening of embeddings against numpy's own eigenvalues and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whiten
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(vectors):
    """(n, sums, integers by vector, eigenvalues, unit vectors, trace) of the distinct vectors."""
    dims = max(map(len, vectors))
    x = [tuple(math.floor(256 * float(c)) for c in v) + (0,) * (dims - len(v)) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(v[d] for v in fit) for d in range(dims)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, x, values[::-1], vectors[:, ::-1], float(np.trace(centred.T @ centred / n))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, sums, x, values, vectors, trace = brute([r["embedding"] for r in rows])
    got = {}
    for r in QUERIES["op13_embedding_whitening"](spark, SF).collect():
        got.setdefault(r["vec_id"], []).append(r)
    assert len(got) == len(rows)
    signs = {}
    for r, v in zip(rows, x):
        mine = sorted(got[r["vec_id"]], key=lambda g: g["component"])
        assert [g["component"] for g in mine] == [1, 2, 3, 4]
        exact = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums)])
        for k, g in enumerate(mine):
            want = float(centred @ vectors[:, k]) / math.sqrt(values[k])
            sign = signs.setdefault(k, 1 if want * g["whitened"] >= 0 else -1)
            assert (g["n"], g["deviation"], g["deviation_text"]) == (n, exact, str(exact))
            assert g["whitened"] * sign == pytest.approx(want, abs=1e-9)
            assert g["explained"] == pytest.approx(values[k] / trace, rel=1e-9) and g["identity_error"] < 1e-10


@pytest.mark.parametrize("dims", [1, 2, 3, 17, 64])
def test_divide_and_conquer_finds_the_largest(dims):
    draw = np.random.default_rng(dims)
    a = draw.standard_normal((dims + 9, dims)) * np.geomspace(1, 30, dims)
    cov = a.T @ a
    values, vectors = whiten.principal(cov, 4)
    want = np.linalg.eigvalsh(cov)[::-1][:4]
    assert values == pytest.approx(want, rel=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(cov @ vectors - vectors * values).max() < 1e-12 * want[0]


def test_equal_eigenvalues_and_none():
    assert whiten.principal(np.diag([5.0, 5, 1, 1, 0]), 9)[0] == pytest.approx([5, 5, 1, 1])
    assert whiten.principal(np.eye(6) * 7, 4)[0] == pytest.approx([7] * 4)
    assert len(whiten.principal(np.zeros((3, 3)))[0]) == len(whiten.principal(np.zeros((0, 0)))[0]) == 0
    near = np.diag([1 + 1e-13, 1.0, 1 - 1e-13, 0.5])
    assert whiten.principal(near, 4)[0] == pytest.approx([1, 1, 1, 0.5])


def test_polar_factor_of_an_indefinite_matrix():
    draw = np.random.default_rng(2)
    q, _ = np.linalg.qr(draw.standard_normal((12, 12)))
    a = q @ np.diag([9, 4, 1, 1e-3, 1e-9, -1e-9, -1e-6, -1, -2, -3, -4, -50]) @ q.T
    u = whiten.polar(a)
    assert np.abs(u @ u - np.eye(12)).max() < 1e-12 and round(np.trace(u)) == -2
    assert np.linalg.eigvalsh(u @ a).min() > -1e-12


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[0.5, -0.25, 1.0], [0.5, -0.25, 1.0], None, [1.0, None, 2.0], [nan, 0.0, 0.0], [inf, 0.0, 0.0], [2.0, 1.0], [], [-3.0, 0.0, 0.001], [3e38, 0.0, 0.0]]
    rows = [(i if i != 6 else None, v, "a", 1) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, component int")
    got = whiten.whitened(frame.filter("vec_id is null or vec_id <> 9")).collect()
    n, sums, x, values, _, trace = brute([v for i, v in enumerate(vectors) if i in (0, 1, 6, 7, 8)])
    assert n == 4 and {r["vec_id"] for r in got} == {0, 1, None, 7, 8}
    assert {r["component"] for r in got} == {1, 2, 3} and len(got) == 15
    assert {r["deviation"] for r in got} == {sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x}
    assert [r["explained"] for r in got if r["component"] == 1] == pytest.approx([values[0] / trace] * 5)
    # An entry beyond 64 bits takes the nearest value; its deviation is only text.
    far = [r for r in whiten.whitened(frame).collect() if r["vec_id"] == 9]
    assert far and far[0]["deviation"] is None and int(far[0]["deviation_text"]) > 1 << 63


def test_vectors_without_variance_and_empty_tables(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whiten.whitened(same).collect() == []
    assert whiten.whitened(same.filter("false")).collect() == []
    assert whiten.whitened(same.withColumn("embedding", same["embedding"].cast("array<double>"))).collect() == []
    assert whiten.whitened(spark.createDataFrame([(1, []), (2, [])], "vec_id long, embedding array<float>")).collect() == []


def test_wide_integers_are_exact():
    x = np.array([[1 << 40, -5], [3, 7]], np.int64)
    sums = whiten.exact_sums(x)
    assert sums == [(1 << 40) + 3, 2]
    assert whiten.deviations(x, sums, 2) == [sum((2 * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
    assert whiten.exact_sums(np.array([[-(1 << 62)], [-(1 << 62)], [-(1 << 62)]], np.int64)) == [-3 * (1 << 62)]
