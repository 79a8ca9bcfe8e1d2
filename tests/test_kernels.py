"""The numpy nearest-centroid kernel equals the exact first-minimum rule."""

import math
import random

import numpy as np

from kestrel.operators import kmeans_kernels as K


def brute(X, C):
    out = []
    for x in X:
        best = None
        for i, c in enumerate(C):
            d = math.sqrt(sum((a - b) ** 2 for a, b in zip(x, c)))
            if best is None or d < best[1]:
                best = (i, d)
        out.append(best)
    return out


def test_exact_on_ties_near_ties_and_far_points():
    rnd = random.Random(4)
    C = np.array([[0.0, 0.0, 0.0], [2.0, 0.0, 0.0], [1.0, 1e-9, 0.0], [1e6, 1e6, 1e6], [1.0, 0.0, 0.0]])
    X = [[1.0, 0.0, 0.0], [1.0, 5.0, -5.0], [1e6 + 0.5, 1e6, 1e6]]  # exact and near ties
    X += [[rnd.uniform(-3, 3) for _ in range(3)] for _ in range(300)]
    X += [[1e6 + rnd.gauss(0, 1e-3) for _ in range(3)] for _ in range(100)]  # far from origin
    X = np.array(X)
    for budget in (7, 4_000_000):  # chunked and unchunked
        idx, dist = K.nearest(X, C, budget=budget)
        want = brute(X.tolist(), C.tolist())
        assert idx.tolist() == [w[0] for w in want]
        assert np.allclose(dist, [w[1] for w in want], rtol=0, atol=1e-9)


def _batch(X, dtype):
    import pyarrow as pa
    values = pa.array(X.astype(dtype).ravel())
    offsets = pa.array(np.arange(0, X.size + 1, X.shape[1], dtype=np.int32))
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, values)], names=["_v"])


def test_partial_pass_sums_match_numpy():
    rnd = np.random.default_rng(1)
    X = rnd.normal(size=(500, 4))
    C = X[:3].copy()
    batches = [_batch(X[:250], np.float64), _batch(X[250:], np.float64).slice(0, 250)]
    out = next(K.partial_pass(iter(batches), 4, [(C, np.array([7, 8, 9]), None, None)]))
    assert out.schema.field("run").type == "int32" and out.schema.field("sums").type.value_type == "double"
    idx, dist = K.nearest(X, C)
    for r in out.to_pylist():
        m = idx == [7, 8, 9].index(r["cid"])
        assert r["n"] == m.sum() and np.isclose(r["sum_dist"], dist[m].sum())
        assert np.allclose(r["sums"], X[m].sum(axis=0)) and r["moved"] == 0


def test_float_batches_widen_exactly_and_respect_slices():
    X = np.random.default_rng(2).normal(size=(10, 3)).astype(np.float32)
    b = _batch(X, np.float32).slice(3, 5)
    got = K._points(b, 3)
    assert got.dtype == np.float64 and np.array_equal(got, X[3:8].astype(np.float64))


def test_matrix_form_matches_exact_distances():
    rng = np.random.default_rng(3)
    X = 10 + 2 * rng.normal(size=(2000, 16))
    for k in (1, 3, 12):
        C = X[:k].copy()
        exact = K._exact(X, C)
        idx, dist = K.nearest(X, C)
        assert (idx == exact.argmin(axis=1)).all() and np.allclose(dist, exact.min(axis=1), rtol=0, atol=1e-12)
