"""Whitening against a dense eigendecomposition, and on tables that a plain Gram matrix cannot serve."""

import math

import numpy as np
import pytest

from wardwatch.llm import queries
from wardwatch.llm.whitening import whiten

SF = "/root/testdata/sf0.001"
NAN, INF = math.nan, math.inf


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(v)) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")


def dense(rows):
    """x, the fit list's n and sums, eigenvalues and vectors of the covariance."""
    x = np.floor(64 * np.array(rows, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    y = (n * fit - sums) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    return x, n, sums, e[::-1], v[:, ::-1]


def against_dense(rows, got, ids, tolerance=1e-8):
    x, n, sums, e, v = dense(rows)
    k = max(r["component"] for r in got)
    w = np.zeros((len(rows), k))
    place = {i: j for j, i in enumerate(ids)}
    for r in got:
        j = place[r["vec_id"]]
        w[j, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-7)
        assert r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[j], sums))
    want = (n * x - sums) / n @ v[:, :k] / np.sqrt(e[:k])
    assert len(got) == len(rows) * k
    assert np.abs(want * np.sign((want * w).sum(0)) - w).max() < tolerance
    return k


def test_query_on_all_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    assert against_dense([r["embedding"] for r in rows], queries.op11_whitening(spark, SF).collect(), [r["vec_id"] for r in rows]) == 16


def test_repeated_vectors_count_once(spark):
    a = np.random.default_rng(1).normal(size=(60, 5)).tolist()
    rows = a + [a[0]] * 200
    assert against_dense(rows, whiten(table(spark, rows)).collect(), range(len(rows))) == 5


@pytest.mark.parametrize("scales", [(1e8, 1e6, 1e3, 1, 0.2, 50), (1e9, 1, 1, 1e-1, 1e5, 1)])
def test_badly_scaled_dimensions(spark, scales):
    rows = (np.random.default_rng(2).normal(size=(300, 6)) * np.array(scales)).tolist()
    got = whiten(table(spark, rows)).collect()
    assert len(got) == 1800 and all(r["identity_error"] < 1e-9 for r in got)


def test_components_without_variance_are_left_out(spark):
    base = np.random.default_rng(3).integers(-3, 4, size=(200, 3)).astype(float)
    rows = np.hstack([base, base[:, :2] * 2, np.ones((200, 2)), base.sum(1, keepdims=True)]).tolist()
    assert against_dense(rows, whiten(table(spark, rows)).collect(), range(200)) == 3
    assert whiten(table(spark, [[1.0, 2.0]] * 4)).collect() == []
    few = np.random.default_rng(4).normal(size=(7, 30)).tolist()
    assert against_dense(few, whiten(table(spark, few), components=99).collect(), range(7)) == 6


def test_odd_rows(spark):
    rows = [None, [], [1.0, None], [NAN, 1.0], [1.0, INF], [1.0, 2.0, 3.0], [0.5, 1.0], [0.5, 1.0], [-1.0, 4.0], [2.0, 2.0]]
    df = table(spark, rows).selectExpr("IF(vec_id = 9, NULL, vec_id) AS vec_id", "embedding", "1 AS component", "'n' AS whitened")
    got = whiten(df).collect()
    assert {r["vec_id"] for r in got} == {6, 7, 8, None} and len(got) == 8 and {r["n"] for r in got} == {3}
    same = lambda i: [tuple(r)[1:] for r in got if r["vec_id"] == i]
    assert same(6) == same(7)
    assert whiten(df.limit(0)).collect() == [] and whiten(df.limit(0)).columns == whiten(df).columns


def test_huge_entries(spark):
    rows = [[1e300, 1.0], [-1e300, 2.0], [1e15, 3.0], [0.0, 4.0]]
    got = whiten(table(spark, rows)).collect()
    assert len(got) >= 4 and all(math.isfinite(r["whitened"]) for r in got) and got[0]["deviation"] is None
