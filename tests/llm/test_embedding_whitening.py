"""Whitening against a dense eigen-decomposition, and its defined cases."""

from fractions import Fraction

import numpy as np
import pytest

from salesmart.llm import embedding_whitening as W
from salesmart.llm.common import table
from salesmart.llm.registry import QUERIES
from tests.llm.conftest import SF, clashing

SCHEMA = "vec_id long, embedding array<float>"


def expected(rows, components=4):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} by definition; rows are (id, vector)."""
    usable = []
    for id, v in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            usable.append((id, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)))
    fit = sorted({x for _, x in usable})
    n, sums = len(fit), np.array(fit, dtype=object).sum(axis=0)
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = []
    for id, x in usable:
        gap = [n * c - s for c, s in zip(x, sums)]
        for k, e in enumerate(values):
            white = np.array([float(Fraction(g, n)) for g in gap]) @ axes[:, k] / np.sqrt(e)
            out.append((id, k + 1, n, sum(g * g for g in gap), white, e / np.trace(covariance)))
    return out


def compare(got, want):
    assert len(got) == len(want)
    sign = {}
    for k in {w[1] for w in want}:
        a = np.array([r["whitened"] for r in got if r["component"] == k])
        b = np.array([w[4] for w in want if w[1] == k])
        sign[k] = 1.0 if np.abs(a - b).max() < np.abs(a + b).max() else -1.0
    for r, w in zip(got, want):
        assert (r["vec_id"], r["component"], r["n"], r["deviation"]) == w[:4]
        assert r["whitened"] * sign[w[1]] == pytest.approx(w[4], rel=1e-9, abs=1e-9)
        assert r["explained"] == pytest.approx(w[5], rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-9


def by_key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))


@pytest.mark.parametrize(
    "spectrum",
    [lambda i: 1 / i, lambda i: 1 + 0.3 / np.sqrt(i), lambda i: 0.9**i, lambda i: np.where(i < 4, 1.0, 0.5), lambda i: np.where(i < 3, 1.0, 0.0)],
)
@pytest.mark.parametrize("length", [1, 3, 40, 300])
def test_solver(spectrum, length):
    """Pairs of a matrix with known ones, also equal and zero ones, and smaller than the subspace."""
    rng = np.random.default_rng(length)
    turn = np.linalg.qr(rng.standard_normal((length, length)))[0]
    true = np.sort(spectrum(np.arange(1, length + 1)))[::-1]
    dense = (turn * np.asarray(spectrum(np.arange(1, length + 1)))) @ turn.T
    calls = []

    def product(columns):
        calls.append(columns.shape)
        return dense @ columns

    values, axes, residual = W.jacobi_davidson(product, length, 4)
    assert values == pytest.approx(true[: len(values)], abs=1e-13) and len(values) == min(4, length)
    assert residual < 64 * W.PRECISION
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
    assert len(calls) < 150 and all(shape[1] <= W.MOST_BASIS for shape in calls)


def test_minres_solves_indefinite_systems_in_step():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    dense = (turn * np.linspace(-3, 5, 30)) @ turn.T
    right = rng.standard_normal((30, 3))
    right[:, 1] = 0
    found = W.minres(lambda v, at: dense @ v[:, at], right, 1e-12, 200)
    assert dense @ found == pytest.approx(right, abs=1e-8)


def test_random_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 12)) * np.linspace(2, 0.2, 12)
    rows = [(i, [float(np.float32(c)) for c in base[i % 250]]) for i in range(300)]  # some vectors twice
    got = W.embedding_whitening(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    compare(by_key(got), sorted(expected(rows), key=lambda r: r[:2]))


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [nan, 0.0, 0.0]), (5, [inf, 0.0, 0.0]), (6, [-0.0, 0.5, 1.0]),
        (7, [0.0, 0.5, 1.0]), (7, [0.0, 0.5, 1.0]), (None, [3.0, -1.0, 0.25]), (8, [0.001, -0.001, 7.5]), (9, [-2.0, 4.0, 1.0]),
        (10, [1.0, 2.0]), (11, [1.0] * 1000),
    ]
    got = W.embedding_whitening(spark.createDataFrame(rows, SCHEMA)).collect()
    kept = [r for r in rows if r[1] and len(r[1]) == 3]
    compare(by_key(got), sorted(expected(kept), key=lambda r: (r[0] is None, r[0], r[1])))
    assert {r["component"] for r in got} == {1, 2, 3}


def test_no_variance_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        assert W.embedding_whitening(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_deviations_beyond_63_bits_are_null_and_large_entries_exact(spark):
    rows = [(i, [2.0**24 * (i % 3), 2.0**20 * i]) for i in range(6)]
    got = by_key(W.embedding_whitening(spark.createDataFrame(rows, SCHEMA)).collect())
    want = expected(rows)
    assert [r["deviation"] for r in got] == [w[3] if w[3] < 1 << 63 else None for w in want]
    assert any(r["deviation"] is None for r in got)


def test_other_columns_and_text_ids(spark):
    rows = [(f"v{i}", [float(i), float(i * i % 7)]) for i in range(9)]
    docs = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    got = W.embedding_whitening(clashing(docs, "id", "x", "v", "n", "component", "whitened")).collect()
    compare(by_key(got), sorted(expected(rows), key=lambda r: r[:2]))


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    got = QUERIES["op11_embedding_whitening"](spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(by_key(got.collect()), sorted(expected(rows), key=lambda r: r[:2]))
