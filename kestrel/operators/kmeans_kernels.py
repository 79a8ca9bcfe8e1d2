"""Per-task numpy kernels for the k-means passes. They run inside
``mapInArrow``: points arrive as one list column whose values are a single
contiguous buffer, so a batch becomes a rows x dims matrix with no per-row
work (one widening copy for FLOAT values).

This module is pickled *by value* with the functions that use it, so executors
need numpy and pyarrow but not this package.
"""

from __future__ import annotations

import numpy as np


def _exact(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Exact distances of every row of X to every row of C (rows x k)."""
    out = np.empty((X.shape[0], C.shape[0]))
    for i in range(C.shape[0]):
        diff = X - C[i]
        out[:, i] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def _distances(X: np.ndarray, C: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """Distance of each row of X to the row of C at its index."""
    diff = X - C[idx]
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def nearest(X: np.ndarray, C: np.ndarray, budget: int = 4_000_000):
    """Index (:func:`nearest_index`) and distance of the nearest row of C for each row
    of X; the distance is computed exactly from the differences."""
    idx = nearest_index(X, C, budget)
    return idx, _distances(X, C, idx)


def nearest_index(X: np.ndarray, C: np.ndarray, budget: int = 4_000_000) -> np.ndarray:
    """Index of the nearest row of C for each row of X.

    Exactly the reference's rule - the first centroid, in order, at the
    smallest Euclidean distance - at matrix-product speed:

    1. squared distances through BLAS, ||x||^2 - 2 x.c + ||c||^2;
    2. every centroid within the rounding bound of a row's best value is a
       candidate (the true minimum is always one of them);
    3. rows with one candidate take it; rows with several (near-ties) are
       decided on exact distances, first minimum winning.

    Rows go in chunks so the k x rows matrix stays under ``budget`` numbers; it lies
    centroid by centroid, so that few centroids cost few long steps.
    """
    n, k, d = X.shape[0], C.shape[0], C.shape[1]
    idx = np.zeros(n, dtype=np.int64)
    cc = np.einsum("ij,ij->i", C, C)
    # float64 rounding of the expansion stays far below this (about 4 d eps)
    rel = 1e-12 * max(d, 1)
    step = max(1, budget // max(1, k))
    for s in range(0, n, step):
        Xs = X[s:s + step]
        xx = np.einsum("ij,ij->i", Xs, Xs)
        D = C @ Xs.T
        D *= -2.0
        D += xx
        D += cc[:, None]
        cand = D <= D.min(axis=0) + 2.0 * rel * (xx + cc.max())
        pick = np.zeros(len(Xs), dtype=np.int64)
        for i in range(k - 1, 0, -1):
            pick[cand[i]] = i
        pick[cand[0]] = 0
        ties = np.flatnonzero(np.count_nonzero(cand, axis=0) > 1)
        if len(ties):
            pick[ties] = np.argmin(_exact(Xs[ties], C), axis=1)
        idx[s:s + step] = pick
    return idx


def _points(batch, d: int) -> np.ndarray:
    """The ``_v`` list column of an Arrow batch as a rows x d float64 matrix.

    The list values are one contiguous buffer; ``flatten`` honours the slice
    offsets and the reshape is free. FLOAT values are widened exactly.
    """
    col = batch.column(batch.schema.get_field_index("_v"))
    flat = col.flatten().to_numpy(zero_copy_only=False)
    X = flat.reshape(len(col), d).astype(np.float64, copy=False)
    if not np.isfinite(X).all():
        raise ValueError("missing or non-finite vector component; use prepare_points")
    return X


def assign_batches(batches, d, keep, C, cids, with_features):
    """Arrow batches in, (keep..., cid, dist[, _v]) batches out."""
    import pyarrow as pa

    for b in batches:
        X = _points(b, d)
        idx, dist = nearest(X, C)
        arrays = [b.column(b.schema.get_field_index(k)) for k in keep]
        arrays += [pa.array(cids[idx].astype(np.int32)), pa.array(dist)]
        names = list(keep) + ["cid", "dist"]
        if with_features:
            arrays.append(b.column(b.schema.get_field_index("_v")))
            names.append("_v")
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def moved_batches(batches, d, C, cids, P, pcids):
    """(id, prev_cid, cid) of the points whose nearest center differs."""
    import pyarrow as pa

    for b in batches:
        X = _points(b, d)
        now, before = cids[nearest_index(X, C)], pcids[nearest_index(X, P)]
        at = np.flatnonzero(now != before)
        ids = b.column(b.schema.get_field_index("id")).take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(before[at].astype(np.int32)), pa.array(now[at].astype(np.int32))],
            names=["id", "prev_cid", "cid"])


def partial_pass(batches, d, runs):
    """Map-side combine of one Lloyd pass for several independent runs.

    ``runs`` is a list of (C, cids, P, pcids): current centroids and ids, and
    the previous pass's (P None on a run's first pass). Yields one Arrow batch
    with a row per (run, cluster) that has members in this task: count, sum of
    distances, sum of squared distances, moved count and the per-dimension
    sums as one array. Group sums are ``bincount``s over the cluster index:
    O(rows * dims) per batch, whatever k.
    """
    import pyarrow as pa

    acc = [None] * len(runs)
    for b in batches:
        X = _points(b, d)
        for r, (C, cids, P, pcids) in enumerate(runs):
            k = C.shape[0]
            idx, dist = nearest(X, C)
            if P is not None:
                moved = (cids[idx] != pcids[nearest_index(X, P)]).astype(np.float64)
            else:
                moved = np.zeros(len(idx))
            part = [np.bincount(idx, minlength=k),
                    np.bincount(idx, weights=dist, minlength=k),
                    np.bincount(idx, weights=dist * dist, minlength=k),
                    np.bincount(idx, weights=moved, minlength=k),
                    np.column_stack([np.bincount(idx, weights=X[:, j], minlength=k)
                                     for j in range(d)]) if d else np.zeros((k, 0))]
            acc[r] = part if acc[r] is None else [a + b_ for a, b_ in zip(acc[r], part)]
    rows = []
    for r, a in enumerate(acc):
        if a is None:
            continue
        cids = runs[r][1]
        for i in np.nonzero(a[0])[0]:
            rows.append((r, int(cids[i]), int(a[0][i]), float(a[1][i]), float(a[2][i]),
                         int(round(a[3][i])), a[4][i].tolist()))
    if rows:
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()),
             pa.array(cols[4], pa.float64()), pa.array(cols[5], pa.int64()),
             pa.array(cols[6], pa.list_(pa.float64()))],
            names=["run", "cid", "n", "sum_dist", "sse", "moved", "sums"])
