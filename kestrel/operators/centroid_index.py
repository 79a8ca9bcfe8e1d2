"""Nearest of many centroids (M13, J6) without every distance.

For large k the rows x k matrix is most of a pass. Here the centroids are grouped
around about sqrt(k) pivots, chosen farthest first, and each group knows its radius.
By the triangle inequality a centroid of a group is no nearer to a point than the
pivot's distance less the radius, so groups that can't beat what the point has found
are skipped. The answer is that of :func:`kmeans_kernels.nearest` to the bit: the
first centroid, in order, at the smallest distance; rounding is allowed for, and a
group at exactly the best distance is still looked into.

The index is made from the k centroids on the driver and travels like them; tasks
search it batch by batch inside ``mapInArrow``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from . import kmeans_kernels as kernels
from .lloyd import Centroids, _ship

cloudpickle.register_pickle_by_value(kernels)

ROWS = 4_096  # points searched at once


@dataclass
class CentroidIndex:
    centers: np.ndarray
    pivots: np.ndarray
    groups: list[np.ndarray]  # places of each pivot's centroids, ascending
    radius: np.ndarray


def build(centers: np.ndarray, n_pivots: int | None = None) -> CentroidIndex:
    """Index of the rows of ``centers``; about sqrt(k) pivots by default."""
    centers = np.ascontiguousarray(centers, dtype=np.float64)
    k = len(centers)
    wanted = min(k, n_pivots or int(np.ceil(np.sqrt(k))))
    chosen = [0]
    gap = kernels._exact(centers, centers[:1])[:, 0]
    while len(chosen) < wanted and gap.max() > 0:  # copies of a pivot need none of their own
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, kernels._exact(centers, centers[chosen[-1:]])[:, 0])
    pivots = centers[chosen]
    owner, dist = kernels.nearest(centers, pivots)
    groups = [np.flatnonzero(owner == g) for g in range(len(chosen))]
    radius = np.array([dist[g].max() for g in groups])
    return CentroidIndex(centers, pivots, groups, radius)


def search(X: np.ndarray, index: CentroidIndex) -> tuple[np.ndarray, np.ndarray, int]:
    """(place, distance) of the nearest centroid of each row, and how many distances
    were worked out."""
    n = len(X)
    place, best = np.zeros(n, np.int64), np.full(n, np.inf)
    worked = 0
    for s in range(0, n, ROWS):
        part = X[s:s + ROWS]
        worked += _search(part, index, place[s:s + ROWS], best[s:s + ROWS])
    return place, best, worked


def _search(X: np.ndarray, index: CentroidIndex, place: np.ndarray, best: np.ndarray) -> int:
    P = index.pivots
    xx, pp = np.einsum("ij,ij->i", X, X), np.einsum("ij,ij->i", P, P)
    squared = xx[:, None] - 2.0 * (X @ P.T) + pp[None, :]
    slack = 4e-12 * max(X.shape[1], 1) * (xx[:, None] + pp[None, :])  # far above the product's rounding
    least = np.sqrt(np.maximum(squared - slack, 0.0)) - index.radius * (1 + 1e-9)
    home = squared.argmin(axis=1)
    worked = len(X) * len(P)

    def look(rows: np.ndarray, g: int) -> int:
        own = index.groups[g]
        at, dist = kernels.nearest(X[rows], index.centers[own])
        found = own[at]
        better = (dist < best[rows]) | ((dist == best[rows]) & (found < place[rows]))
        place[rows[better]], best[rows[better]] = found[better], dist[better]
        return len(rows) * len(own)

    for g in np.unique(home):
        worked += look(np.flatnonzero(home == g), g)
    # the groups that could be nearest to many points first: bounds fall sooner
    for g in np.argsort(least.mean(axis=0), kind="stable"):
        rows = np.flatnonzero((least[:, g] <= best * (1 + 1e-9)) & (home != g))
        if len(rows):
            worked += look(rows, g)
    return worked


def assign_many(points: DataFrame, cents: Centroids, keep: Sequence[str] = ("id",),
                n_pivots: int | None = None) -> DataFrame:
    """``keep`` columns, ``cid``, ``dist`` for prepared points, as ``lloyd.assign``
    gives them, through the index."""
    index = build(np.asarray(cents.centers, dtype=np.float64), n_pivots)
    cids = np.asarray(cents.cids, dtype=np.int32)
    d, keep = cents.dims, list(keep)
    src = points.select(*keep, "_v")
    schema = StructType([src.schema[k] for k in keep]
                        + [StructField("cid", IntegerType()), StructField("dist", DoubleType())])
    parts = (index.centers, index.pivots, index.groups, index.radius, cids)
    get, _ = _ship(points.sparkSession, parts)  # lives as long as the DataFrame

    def assign(batches):
        import pyarrow as pa

        *own, ids = get()
        tree = CentroidIndex(*own)
        for b in batches:
            place, dist, _ = search(kernels._points(b, d), tree)
            arrays = [b.column(b.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(ids[place]), pa.array(dist)],
                                             names=[*keep, "cid", "dist"])

    return src.mapInArrow(assign, schema)
