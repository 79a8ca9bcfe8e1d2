"""The index finds what the full kernel finds, with fewer distances."""

import numpy as np
import pytest

from kestrel.operators import centroid_index as I
from kestrel.operators import kmeans_kernels as K
from kestrel.operators import lloyd as L


def _blobs(rng, n, d, blobs):
    middle = rng.normal(0, 20, (blobs, d))
    return middle[rng.integers(0, blobs, n)] + rng.normal(0, 1, (n, d))


@pytest.mark.parametrize("k,d", [(10_000, 16), (10_000, 2), (700, 64)])
def test_equal_to_the_kernel_with_fewer_distances(k, d):
    rng = np.random.default_rng(k + d)
    C, X = _blobs(rng, k, d, 60), _blobs(rng, 3_000, d, 60)
    C[k // 2] = C[3]  # a copy: the first one wins
    X[:50] = C[rng.integers(0, k, 50)]
    X[50] = C[3]
    X[51] = (C[0] + C[1]) / 2
    X[52] = 1e6
    want, far = K.nearest(X, C)
    place, dist, worked = I.search(X, I.build(C))
    assert (place == want).all() and (dist == far).all()
    assert place[50] == 3
    assert worked < len(X) * k / (2 if k == 10_000 else 1)


def test_ties_and_small_sets():
    C = np.array([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [0.0, -1.0], [1.0, 0.0]])
    X = np.array([[0.0, 0.0], [2.0, 0.0], [-1.0, -1.0], [0.0, 0.0]])
    for pivots in (1, 2, 5):
        place, dist, _ = I.search(X, I.build(C, pivots))
        assert place.tolist() == [0, 0, 2, 0] and dist.tolist() == [1.0, 1.0, 1.0, 1.0]
    same = np.zeros((9, 3))
    place, dist, _ = I.search(np.ones((2, 3)), I.build(same))
    assert place.tolist() == [0, 0]
    assert I.search(np.empty((0, 3)), I.build(same))[2] == 0


def test_assign_many_is_assign(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(_blobs(rng, 500, 4, 7))]
    points, *_ = L.prepare_points(spark.createDataFrame(rows, "id long, features array<float>"))
    cents = L.init_centroids(points, 60, "lowest")
    want = sorted(map(tuple, L.assign(points, cents).collect()))
    assert sorted(map(tuple, I.assign_many(points, cents).collect())) == want
