"""Whitening against numpy's eigendecomposition; the spectrum's updates; odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.llm import whitening
from ferrule.llm.queries import op11_embedding_whitening
from ferrule.llm.spectrum import Spectrum, secular_roots, update

SCHEMA = "vec_id long, embedding array<double>, label int"


def matrices():
    rng = np.random.default_rng(0)
    return {
        "normal": np.floor(256 * rng.normal(size=(300, 32))),
        "low rank": np.floor(50 * rng.normal(size=(200, 3)) @ rng.normal(size=(3, 20))),
        "equal rows": np.tile(np.floor(rng.normal(size=8) * 100), (5, 1)),
        "scales": rng.normal(size=(200, 16)) * 10.0 ** np.arange(16)[None] / 1e8,
        "one hot": np.eye(12)[rng.integers(12, size=100)] * 256,
        "offset": 1e7 + np.floor(256 * rng.normal(size=(200, 16))),
        "one column": rng.normal(size=(10, 1)),
        "zero": np.zeros((4, 6)),
    }


@pytest.mark.parametrize("name", list(matrices()))
def test_updates_give_the_scatter(name):
    x = matrices()[name]
    whole, parts = Spectrum.empty(x.shape[1]), [Spectrum.empty(x.shape[1]) for _ in range(3)]
    for k, row in enumerate(x):
        whole.add(row)
        parts[k % 3].add(row)
    parts[0].merge(parts[1])
    parts[0].merge(parts[2])
    c = x - x.mean(0)
    scatter = c.T @ c
    size = max(np.abs(scatter).max(), 1e-300)
    for s in (whole, parts[0]):
        assert s.n == len(x) and np.allclose(s.mean, x.mean(0), rtol=1e-12)
        assert np.abs(s.u.T @ s.u - np.eye(x.shape[1])).max() < 1e-12
        assert np.abs(s.u @ np.diag(s.w) @ s.u.T - scatter).max() / size < 1e-10
        assert np.abs(s.w - np.linalg.eigvalsh(scatter)).max() / size < 1e-10


def test_roots_lie_between_poles():
    rng = np.random.default_rng(1)
    for k in (1, 2, 5, 40):
        d = np.sort(rng.normal(size=k)) * 10.0 ** rng.integers(-3, 4)
        z2 = rng.random(k) ** 8 + 1e-14
        x, apart = secular_roots(d, z2)
        assert np.all(x[:-1] <= d[1:]) and np.all(x >= d) and x[-1] <= d[-1] + z2.sum() * (1 + 1e-12)
        inside = np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2))
        assert np.allclose(x, np.linalg.eigvalsh(inside), rtol=1e-12, atol=1e-13 * np.abs(inside).max())
        assert np.all(np.abs(1 + (z2 / apart).sum(1)) < 1e-6 * (1 + np.abs(z2 / apart).sum(1)))


def test_deflation_keeps_equal_values_exact():
    w, u = update(np.array([2.0, 2.0, 2.0, 5.0]), np.eye(4), np.array([1.0, 1.0, 1.0, 0.0]))
    assert np.allclose(w, [2, 2, 5, 5]) and np.allclose(u.T @ u, np.eye(4))


def wanted(table):
    """Plain results by id from (id, vector) rows."""
    rows = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in table]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in rows}))
    n, total = len(fit), fit.sum(0)
    c = (n * fit - total) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in rows:
        e = n * x - total
        out[i] = (n, sum(int(v) ** 2 for v in e), (e / n) @ vectors[:, :4] / np.sqrt(values[:4]), values[:4] / values.sum())
    return out


def compare(got, want, tol):
    assert {r["vec_id"] for r in got} == set(want)
    by = {}
    for r in got:
        by.setdefault(r["component"], {})[r["vec_id"]] = r
    for k, rows in by.items():
        ids = sorted(rows)
        ours = np.array([rows[i]["whitened"] for i in ids])
        theirs = np.array([want[i][2][k - 1] for i in ids])
        sign = np.sign(ours @ theirs)
        assert np.abs(ours - sign * theirs).max() < tol
        for i in ids:
            assert rows[i]["n"] == want[i][0] and rows[i]["deviation"] == want[i][1]
            assert abs(rows[i]["explained"] / want[i][3][k - 1] - 1) < 1e-10
            assert rows[i]["identity_error"] < 1e-10


def test_query_on_the_given_table(spark, sf):
    table = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(op11_embedding_whitening(spark, sf).collect(), wanted(table), 1e-9)


def test_copies_count_once_and_offsets_stay_exact(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 6)) * [9, 7, 5, 4, 1, 1] + 40_000
    table = [(k, base[k].tolist()) for k in range(60)] + [(100 + k, base[0].tolist()) for k in range(40)]
    df = spark.createDataFrame([(i, v, 0) for i, v in table], SCHEMA).repartition(7)
    compare(whitening.whiten(spark, df).collect(), wanted(table), 1e-9)


def test_many_columns_need_residual_passes(spark):
    """With a basis that knows nothing the passes still find the leading components."""
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(400, 40)) * np.linspace(3, 1, 40))
    fit = spark.createDataFrame([(r.astype(int).tolist(),) for r in x], "x array<long>")
    start = np.linalg.qr(rng.normal(size=(40, 12)))[0]
    old, whitening.PASSES = whitening.PASSES, 60
    try:
        got = whitening.refine(fit, 40, 400, [int(v) for v in x.sum(0)], start, 4)
    finally:
        whitening.PASSES = old
    c = x - x.mean(0)
    values = np.linalg.eigvalsh(c.T @ c / 400)[::-1]
    assert np.allclose(got.values, values[:4], rtol=1e-9) and abs(got.trace / values.sum() - 1) < 1e-12


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 0.0], 0), (2, [0.0, 2.0], 0), (2, [0.0, 2.0], 0), (None, [3.0, -1.5], 0), (5, [0.0, 0.0], None), (6, [-0.0, 0.0], 1)]
    bad = [(7, None, 0), (8, [], 0), (9, [1.0, None], 0), (10, [nan, 1.0], 0), (11, [1.0, -inf], 0), (12, [1.0, 2.0, 3.0], 0)]
    df = spark.createDataFrame(good + bad, SCHEMA).selectExpr("*", "1 AS x", "2 AS part", "3 AS n", "'u' AS u")
    got = whitening.whiten(spark, df).collect()
    assert sorted((r["vec_id"] or -1, r["component"]) for r in got) == sorted((i or -1, k) for i, _, _ in good for k in (1, 2))
    assert {r["n"] for r in got} == {4} and max(r["identity_error"] for r in got) < 1e-12
    assert whitening.whiten(spark, df.limit(0)).collect() == []
    flat = whitening.whiten(spark, spark.createDataFrame([(1, [0.5, 0.5, 1.0], 0), (2, [0.5, 0.5, 2.0], 0), (3, [0.5, 0.5, 4.0], 0)], SCHEMA)).collect()
    assert {(r["component"], r["whitened"] is None, round(r["explained"], 9)) for r in flat} == {(1, False, 1.0), (2, True, 0.0), (3, True, 0.0)}
    one = whitening.whiten(spark, spark.createDataFrame([(1, [0.5], 0)], SCHEMA)).collect()
    assert [tuple(r) for r in one] == [(1, 1, 1, 0, None, 0.0, 0.0)]


def test_huge_entries_do_not_wrap(spark):
    rows = [(1, [1e12, 1.0], 0), (2, [-1e12, 2.0], 0), (3, [1e30, 5.0], 0), (4, [0.0, 9.0], 0)]
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 8 and got[3, 1]["deviation"] is None
    assert all(np.isfinite(got[i, 1]["whitened"]) and got[i, 2]["whitened"] is None for i in (1, 2, 3, 4))
