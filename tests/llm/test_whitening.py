"""Whitening against plain linear algebra."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from larkspur.llm import eigen, whitening


def spectrum(values, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("matrix", [
    spectrum(np.linspace(1, 50, 64)), spectrum([5.0] * 10 + [3.0] * 10 + [0.0] * 44), spectrum(10.0 ** -np.linspace(0, 9, 90)),
    spectrum(1 + 1e-13 * np.arange(40)), np.eye(30) * 2, np.diag(np.arange(20.0)), np.zeros((6, 6)), np.array([[3.0]]),
    np.array([[2.0, 1.0], [1.0, 2.0]]), np.kron(np.eye(8), [[2.0, 1.0], [1.0, 2.0]])])
def test_leading_components(matrix):
    values, vectors = eigen.leading_components(matrix, 16)
    want = np.linalg.eigvalsh(matrix)[::-1][:16]
    size = max(np.abs(want).max(), 1e-300)
    assert len(values) == min(16, len(matrix))
    assert np.abs(values - want).max() <= 1e-13 * size
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-13
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() <= 1e-13 * size


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=2, max_size=12), st.data())
def test_sturm_counts(diagonal, data):
    off = np.array(data.draw(st.lists(st.floats(-3, 3), min_size=len(diagonal) - 1, max_size=len(diagonal) - 1)))
    points = np.array([-20.0, -1.003, 0.337, 2.771, 20.0])
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    got = eigen.count_below(np.array(diagonal), off, points)
    for point, n in zip(points, got):
        assert (values < point - 1e-9).sum() <= n <= (values < point + 1e-9).sum()


def vectors(n, width, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, width)) @ np.diag(3.0 ** -np.arange(width)) + rng.normal(size=width)
    return [[float(np.float32(v)) for v in row] for row in base]


def plain(rows, k=16):
    """Whitened rows by numpy, up to the sign of each component."""
    x = [(i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}))
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    covariance = y.T @ y / n
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1][:k], components[:, ::-1][:, :k]
    white = [(i, (np.array(v) - sums / n) @ components / np.sqrt(values), sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, sums))) for i, v in x]
    return n, white, values / np.trace(covariance)


def check(found, rows, k):
    n, white, explained = plain(rows, k)
    got = {}
    for row in found:
        assert row["n"] == n and row["identity_error"] < 1e-9
        assert abs(row["explained"] / explained[row["component"] - 1] - 1) < 1e-9
        got.setdefault((row["vec_id"], row["deviation"]), []).append((row["component"], row["whitened"]))
    assert len(found) == len(rows) * len(explained)
    signs = None
    for vec_id, want, deviation in white:
        own = dict(got[vec_id, deviation])
        own = np.array([own[c + 1] for c in range(len(want))])
        assert np.abs(np.abs(own) - np.abs(want)).max() < 1e-6
        here = np.where(np.abs(want) > 1e-3, np.sign(own * want), 0)
        signs = here if signs is None else np.where(signs == 0, here, signs)
        assert ((here == 0) | (here == signs)).all()


def test_whitened_rows(spark):
    rows = list(enumerate(vectors(900, 5)))
    rows += [(7, rows[0][1]), (2000, rows[5][1]), (2001, rows[5][1]), (None, rows[6][1])]
    odd = [(3000, None), (3001, [1.0, None, 1.0, 1.0, 1.0]), (3002, [float("nan")] + [0.0] * 4), (3003, [float("inf")] + [0.0] * 4),
           (3004, []), (3005, [1.0, 2.0]), (3006, [1e30] + [0.0] * 4)]
    frame = spark.createDataFrame([(i, v, -1, -1.0) for i, v in rows + odd], "vec_id BIGINT, embedding ARRAY<FLOAT>, n INT, whitened DOUBLE")
    check(whitening.whitened_components(frame.repartition(7)).collect(), rows, 16)


def test_more_dimensions_than_components_and_text_ids(spark):
    rows = [(f"v{i}", v) for i, v in enumerate(vectors(300, 20, seed=2))]
    rows = [(i, [10 * 3.0 ** (0.9 * j) * c for j, c in enumerate(v)]) for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id STRING, embedding ARRAY<DOUBLE>")
    check(whitening.whitened_components(frame).collect(), rows, 16)


def test_tables_without_spread(spark):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whitened_components(spark.createDataFrame(rows, schema)).collect() == []
    flat = [(i, [1.0, float(i), 2.0 * i]) for i in range(10)]
    found = whitening.whitened_components(spark.createDataFrame(flat, schema)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 10
    assert abs(found[0]["explained"] - 1) < 1e-12


def test_deviations_beyond_64_bits():
    x = np.array([[10 ** 9, 0], [0, 1]])
    assert whitening.deviations(x, 10 ** 6, [0, 0]) == [None, 10 ** 12]
    assert whitening.deviations(x, 3, [1, 1]) == [(3 * 10 ** 9 - 1) ** 2 + 1, 5]
