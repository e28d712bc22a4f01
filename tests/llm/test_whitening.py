"""Whitening against a plain eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest

from pensio.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label string, n int, x string"


@pytest.fixture
def table(spark):
    def build(rows):
        return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "l", 1, "y") for i, v in rows], SCHEMA)

    return build


def hard_matrices():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 5, 16, 40):
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        pair = np.vstack([np.eye(d), -np.eye(d)])
        two = pair * np.where(np.arange(d) < d // 2, 1, 2)
        near = np.diag(np.abs(np.arange(d) - d // 2) + 3.0) + np.eye(d, k=1) + np.eye(d, k=-1)
        yield rng.normal(size=(300, d))
        yield rng.normal(size=(300, d)) * 10.0 ** -np.linspace(0, 6, d)  # variances of very different size
        yield rng.normal(size=(max(2, d // 2), d))  # fewer rows than places
        yield np.repeat(rng.normal(size=(4, d)), 10, 0)
        yield np.ones((10, d))
        yield from (pair, pair @ turn, two, two @ turn)  # equal variances
        yield np.vstack([near, -near])  # pairs of variances equal to working precision


@pytest.mark.parametrize("x", list(hard_matrices()))
def test_directions_of_a_triangular_factor(x):
    n, d = x.shape
    c = x - x.mean(0)
    r = np.linalg.qr(c, mode="r")
    r = np.vstack([r, np.zeros((d - len(r), d))])
    squares, v = whitening.directions(r)
    wanted = np.linalg.svd(c, compute_uv=False) ** 2
    k = len(squares)
    assert k == np.linalg.matrix_rank(c)
    assert np.allclose(squares, wanted[:k], rtol=1e-9, atol=1e-14 * wanted[0])
    assert np.abs(v.T @ v - np.eye(k)).max(initial=0) < 1e-11
    y = c @ v / np.sqrt(squares / n)
    assert np.abs(y.T @ y / n - np.eye(k)).max(initial=0) < 1e-7


def test_small_values_keep_their_digits():
    """Squared singular values of a graded bidiagonal, against exact products for a diagonal one and its inverse's."""
    a = 10.0 ** -np.arange(8)
    b = a[1:] * 0.5
    m = np.diag(a) + np.diag(b, 1)
    inverse = np.linalg.svd(np.linalg.inv(m), compute_uv=False)
    assert np.allclose(whitening.dqds(a, b), np.sort(1 / inverse**2)[::-1], rtol=1e-9, atol=0)


def plain(rows, components=32):
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    d = len(good[0][1])
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(r[j] for r in x) for j in range(d)]
    off = [[n * c - s for c, s in zip(r, sums)] for r in x]
    deviation = [sum(c * c for c in r) for r in off]
    c = np.array(off, float) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    keep = [k for k in range(min(components, d)) if e[k] > 1e-9 * e[0]]
    y = c @ v[:, keep] / np.sqrt(e[keep])
    return {(good[i][0], k + 1): (n, deviation[i], y[i, k], e[k] / e.sum()) for i in range(n) for k in keep}


def test_digests_are_those_of_a_plain_eigendecomposition(table):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=40) * np.linspace(2, 0.2, 40)) for i in range(400)]
    rows += [(1000, None), (1001, []), (1002, [None] * 40), (1003, [float("nan")] * 40), (1004, [float("inf")] + [0.0] * 39)]
    rows += [(1005, [1.0] * 7), (None, rows[5][1])]
    frame = table(rows)
    got = whitening.digests(frame).collect()
    wanted = plain([r for r in rows if r[0] != 1005])
    assert len(got) == len(wanted) == 401 * 32
    sign = {}
    for r in got:
        n, deviation, y, explained = wanted[r.vec_id, r.component]
        sign.setdefault(r.component, np.sign(y * r.whitened))
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened * sign[r.component] - y) < 1e-8 and abs(r.explained - explained) < 1e-12
        assert r.identity_error < 1e-10


def test_repeated_and_constant_rows(table):
    v, w = [0.5, -1.0, 2.0], [0.25, 3.0, 2.0]
    got = whitening.digests(table([(1, v), (1, v), (2, w)])).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in got) == [(1, 1, 3), (1, 1, 3), (2, 1, 3)]
    assert sum(r.whitened for r in got) == pytest.approx(0, abs=1e-12)
    assert whitening.digests(table([(1, v), (2, v)])).count() == 0
    assert whitening.digests(table([(1, None)])).count() == 0
    assert whitening.digests(table([(1, v)]).where("vec_id > 1")).count() == 0


def test_deviations_beyond_plain_products():
    model = whitening.Model(10**9, np.array([10**15, 10**15]), np.zeros(0), np.zeros((2, 0)), 0.0)
    got = whitening.deviations(np.array([[10**6 + 1, 10**6], [10**6 + 9, 10**6]]), model).to_pylist()
    assert got == [10**18, None]


def test_arrays_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)  # several rounds of reduction
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 6)) @ rng.normal(size=(6, 6)) + 5
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, x array<double>").repartition(12)
    model = whitening.fit(frame, "x", 4)
    out = whitening.apply(frame, model)
    assert out.columns == ["vec_id", "x", "whitened"]
    y = np.array([r.whitened for r in out.collect()])
    assert np.abs(np.cov(y.T, bias=True) - np.eye(4)).max() < 1e-12
    assert model.explained == pytest.approx(np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1][:4] / np.trace(np.cov(x.T)))
    assert whitening.identity_error(frame, model) < 1e-12
