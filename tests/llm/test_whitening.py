"""Whitening equals the eigenvectors of the integer covariance, on hard cases too."""

import math

import numpy as np
import pytest

from terrapipe.llm.whitening import whiten

COLUMNS = "vec_id long, embedding array<float>, n long, label string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], COLUMNS).repartition(3)


def expected(vectors, k):
    x = np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n = len(x)
    away = n * x - x.sum(axis=0)
    centred = away / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, axes = values[order], axes[:, order]
    deviation = [d if (d := sum(int(v) ** 2 for v in row)) < 2 ** 63 else None for row in away]
    return n, deviation, (centred @ axes / np.sqrt(np.where(values > 0, values, 1)))[:, :k], (values / values.sum())[:k]


def whitened(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r.vec_id, []).append(r)
    return {i: sorted(found, key=lambda r: r.component) for i, found in rows.items()}


@pytest.mark.parametrize("spread", [1.0, 1e4])
def test_equals_eigenvectors(spark, spread):
    rng = np.random.default_rng(5)
    scales = np.geomspace(20 * spread, 20, 12)
    vectors = (rng.normal(size=(500, 12)) * scales) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    vectors = vectors.astype(np.float32)
    found = whitened(whiten(table(spark, [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]), 8))
    n, deviation, values, shares = expected(vectors, 8)
    assert len(found) == n
    signs = None
    for i, rows in found.items():
        assert [r.component for r in rows] == list(range(1, 9))
        assert {r.n for r in rows} == {n} and {r.deviation for r in rows} == {deviation[i]}
        got = np.array([r.whitened for r in rows])
        signs = np.sign(got * values[i]) if signs is None else signs
        np.testing.assert_allclose(got * signs, values[i], atol=1e-7)
        np.testing.assert_allclose([r.explained for r in rows], shares, rtol=1e-7)
        assert rows[0].identity_error < 1e-9


def test_rows_left_out_and_kept(spark):
    nan, inf = math.nan, math.inf
    rng = np.random.default_rng(1)
    good = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(40, 3)).astype(np.float32))]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [nan, 0.0, 0.0]), (104, [inf, 0.0, 0.0]), (105, [1.0, 2.0]),
           (None, [1.0, 2.0, 3.0]), (7, [0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5])]
    df = whiten(table(spark, good + odd))
    rows = df.collect()
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(rows) == 43 * 3 and {r.n for r in rows} == {43}
    ids = [r.vec_id for r in rows]
    assert ids.count(7) == 9 and ids.count(None) == 3 and not set(ids) & {100, 101, 102, 103, 104, 105}


def test_without_variance(spark):
    """Constant and repeated dimensions: components without variance are named so; one row, no row."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 2)).astype(np.float32)
    vectors = [(i, [float(a), float(a), 3.0, float(b)]) for i, (a, b) in enumerate(base)]
    rows = next(iter(whitened(whiten(table(spark, vectors))).values()))
    assert [r.whitened is None for r in rows] == [False, False, True, True]
    assert rows[2].explained == rows[3].explained == 0 and rows[0].identity_error < 1e-9
    assert sum(r.explained for r in rows) == pytest.approx(1)
    one = whiten(table(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in one] == [(None, None, None, 0)] * 2
    assert whiten(table(spark, [])).collect() == [] and whiten(table(spark, [(1, []), (2, None)])).collect() == []


def test_huge_entries(spark):
    rows = whiten(table(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(rows) == 6 and all(r.deviation is None for r in rows if r.vec_id != 3)
