"""Operator 11 against a direct eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from storepulse.llm import queries, whitening
from storepulse.llm.frames import ship


def usable(rows):
    ok = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) < 2 ** 46 for c in v)]
    sizes = [len(v) for _, v in ok]
    dims = min(set(sizes), key=lambda s: (-sizes.count(s), s)) if ok else 0
    return [(k, v) for k, v in ok if len(v) == dims]


def check(rows, got, k=32):
    """The rows of ``got`` (id, component, n, deviation, whitened, explained, identity_error) are right."""
    fit = usable(rows)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in fit]
    n, s = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(row, s)) for row in x]
    centred = np.array([[float(c * n - t) / n for c, t in zip(row, s)] for row in x])
    v = centred.T @ centred / n
    e = np.linalg.eigvalsh(v)[::-1]
    own = int((e[:k] > 1e-13 * np.trace(v)).sum())
    assert len(got) == n * own
    assert {r[1] for r in got} == set(range(1, own + 1))
    assert {r[2] for r in got} == {n}
    got = sorted(got, key=lambda r: (r[0], r[3] is None, r[3], r[1]))
    rows_of = sorted(((i, d if d < 2 ** 63 else None) for (i, _), d in zip(fit, deviation)), key=lambda r: (r[0], r[1] is None, r[1]))
    assert [(r[0], r[3]) for r in got[::own]] == rows_of
    np.testing.assert_allclose([r[5] for r in got[:own]], e[:own] / np.trace(v), rtol=1e-9)
    # projections on unit eigenvectors: the whitened Gram matrix gives back each row's part of the covariance
    w = np.array([r[4] for r in got]).reshape(n, own)
    np.testing.assert_allclose(w.T @ w / n, np.eye(own), atol=1e-9)
    np.testing.assert_allclose(w.sum(0) / n, 0, atol=1e-9)
    assert {r[6] for r in got} and max(r[6] for r in got) < 1e-9


def run(spark, rows, k=32, parts=3, **extra):
    frame = spark.createDataFrame([(i, v, "x", 7.0) for i, v in rows], "vec_id long, embedding array<float>, n string, whitened double")
    frame = frame.repartition(parts)
    model = whitening.fit(frame, components=k)
    out = whitening.whiten(frame, model, carry=["vec_id"])
    return model, [tuple(r) for r in out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()]


@pytest.mark.parametrize("n,dim,k", [(300, 70, 32), (90, 60, 8), (40, 5, 32), (20, 60, 32)])
def test_equals_direct_decomposition(spark, n, dim, k):
    ship(spark)
    rng = np.random.default_rng(n)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(size=(n, dim)) * rng.uniform(0.5, 3, dim))]
    rows += [(900, None), (901, []), (902, [float("nan")] * dim), (903, [None] * dim), (904, [1.0] * (dim + 1)),
             (905, [float("-inf")] + [0.0] * (dim - 1)), (906, [1e30] * dim), (907, rows[0][1]), (907, rows[1][1])]
    model, got = run(spark, rows, k)
    check(rows, got, k)
    assert model.miss < 1e-9 and model.residual < 1e-12
    fit = np.floor(64 * np.array([v for _, v in usable(rows)], np.float64))
    e, q = np.linalg.eigh(np.cov(fit.T, bias=True))
    same = np.abs((q[:, ::-1][:, :model.values.size] * model.vectors).sum(0))
    np.testing.assert_allclose(same, 1, atol=1e-9)


def test_more_tasks_than_go_to_the_driver(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(whitening, "FEW_TASKS", 2)
    rng = np.random.default_rng(5)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(size=(120, 6)))]
    check(rows, run(spark, rows, parts=5)[1])


def test_equal_eigenvalues_behind_the_block_widen_it(spark, monkeypatch):
    """One-hot vectors have one eigenvalue many times: no edge behind any block but the whole space."""
    ship(spark)
    monkeypatch.setattr(whitening, "PATIENCE", 1)
    dim = 60
    rows = [(i, [1.0 if j == i % dim else 0.0 for j in range(dim)]) for i in range(2 * dim)]
    model, got = run(spark, rows, 4)
    check(rows, got, 4)


def test_one_large_direction(spark):
    """The degree falls where the largest eigenvalue would drown the others."""
    ship(spark)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(150, 64))
    x[:, 0] *= 1e4
    check(rows := [(i, np.float32(v).tolist()) for i, v in enumerate(x)], run(spark, rows, 6)[1], 6)


def test_no_component(spark):
    ship(spark)
    assert run(spark, []) == (None, [])
    assert run(spark, [(1, None), (2, [])]) == (None, [])
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])]) == (None, [])


def test_long_deviations(spark):
    """Sums beyond 64-bit steps are exact, beyond a long null."""
    ship(spark)
    rows = [(1, [2.0 ** 24]), (2, [-(2.0 ** 24)]), (3, [5.0])]
    check(rows, run(spark, rows)[1])
    rows = [(1, [2.0 ** 40]), (2, [-(2.0 ** 40)]), (3, [5.0])]
    got = run(spark, rows)[1]
    check(rows, got)
    assert {r[0]: r[3] for r in got}[1] is None


def test_query(spark):
    out = queries.op11_whitening(spark, "/root/testdata/sf0.001")
    got = [tuple(r) for r in out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()]
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, got)
