from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from helpers import SF

from sluice.llm.queries import QUERIES
from sluice.llm.whitening import leading_vectors, whiten


def _plain(vectors):
    """(n, exact deviations, covariance) by whole-number arithmetic."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    u = np.array([[n * r[j] - sums[j] for j in range(d)] for r in x], object)
    return n, [sum(int(c) ** 2 for c in r) for r in u], (u.T @ u).astype(float) / n**3, u.astype(float) / n


def _compare(got, ids, vectors, components):
    n, deviations, covariance, centred = _plain(vectors)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    want = centred @ axes / np.sqrt(values)
    white = np.zeros_like(want)
    place = {v: i for i, v in enumerate(ids)}
    for r in got:
        i = place[r.vec_id]
        white[i, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviations[i]
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(covariance), rel=1e-9)
        assert 0 <= r.identity_error <= 1e-9
    assert len(got) == want.size
    for k in range(want.shape[1]):  # either sign, the same for all rows
        assert min(np.abs(white[:, k] - want[:, k]).max(), np.abs(white[:, k] + want[:, k]).max()) < 1e-8
    assert np.allclose(np.cov(white.T, bias=True), np.eye(want.shape[1]), atol=1e-9)


def test_whitening_query_equals_dense_algebra(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    _compare(QUERIES["op13_embedding_whitening"](spark, SF).collect(), [r.vec_id for r in rows], [r.embedding for r in rows], 32)


@pytest.mark.parametrize("kind", ["spread", "equal", "pairs", "flat", "steep"])
@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_eigenvectors_of_any_spectrum(kind, d):
    draw = np.random.default_rng(d)
    q = np.linalg.qr(draw.standard_normal((d, d)))[0]
    spectrum = {"spread": np.sort(draw.random(d))[::-1] * 100, "equal": np.full(d, 3.0), "pairs": (np.arange(d, 0, -1) + 1) // 2 * 2.0,
                "flat": np.r_[np.full(d - d // 2, 5.0), np.zeros(d // 2)], "steep": 10.0 ** -np.arange(d)}[kind]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = leading_vectors(a, min(32, d))
    assert np.allclose(values, spectrum[: len(values)], atol=1e-13 * spectrum[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * values, atol=1e-13 * spectrum[0])


def test_whitening_of_odd_rows(spark):
    draw = np.random.default_rng(5)
    good = [[float(c) for c in v] for v in draw.standard_normal((40, 3)) * [1, 5, 0.2]]
    rows = [(i, v, "x", "y") for i, v in enumerate(good)] + [(40, good[0], None, None), (40, good[0], None, None)]
    kept = rows + [(None, good[1], "x", "y")]
    nan, inf = float("nan"), float("inf")
    dropped = [(90, None, "x", "y"), (91, [1.0, None, 2.0], "x", "y"), (92, [nan, 1.0, 1.0], None, "y"), (93, [inf, 1.0, 1.0], "x", "y"),
               (94, [1.0], "x", "y"), (95, [], "x", "y"), (96, [-inf, 0.0, 0.0], "x", "y")]
    fields = "vec_id long, embedding array<float>, n string, component string"
    got = whiten(spark.createDataFrame(kept + dropped, fields)).collect()
    counts = defaultdict(int)
    for r in got:
        counts[r.vec_id] += 1
    assert counts == {**{i: 3 for i in range(40)}, 40: 6, None: 3} and {r.n for r in got} == {43}
    vectors = [[float(np.float32(c)) for c in r[1]] for r in kept]
    _, deviations, _, _ = _plain(vectors)
    assert {r.deviation for r in got if r.vec_id is None} == {deviations[-1]}
    assert max(r.identity_error for r in got) < 1e-9

    assert whiten(spark.createDataFrame([], fields)).collect() == []
    assert whiten(spark.createDataFrame(rows[:1], fields)).collect() == []  # no variance
    flat = [(i, [1.0, float(i), 2.0 * i], "x", "y") for i in range(9)]  # a constant and a dependent dimension
    assert {r.component for r in whiten(spark.createDataFrame(flat, fields)).collect()} == {1}
    wild = [(i, [float(i % 3) * 1e30, float(i)], "x", "y") for i in range(9)]
    assert {r.component for r in whiten(spark.createDataFrame(wild, fields)).collect()} == {1}
    assert any(isinstance(r.deviation, Decimal) or r.deviation is None for r in whiten(spark.createDataFrame(wild, fields)).collect())
