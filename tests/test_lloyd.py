"""Lloyd k-means against a plain-Python brute force of the reference's loop."""

import math
import random

import pytest

from pyspark.sql import functions as F

from kestrel.functions.arrays import euclidean
from kestrel.operators import lloyd as L
from kestrel.operators.vectors import vector_sum_by_key


def brute_lloyd(points, init, max_iterations):
    """Reference semantics in plain Python: first-minimum assignment, empty
    clusters vanish, stop on no movement (from pass 1) or at max_iterations.
    Returns (metric, iterations, assignment)."""
    cents = {i: list(c) for i, c in enumerate(init)}

    def dist(a, b):
        return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))

    def assign():
        out = {}
        for pid, p in points.items():
            best = None
            for cid in sorted(cents):
                d = dist(p, cents[cid])
                if best is None or d < best[1]:
                    best = (cid, d)
            out[pid] = best
        return out

    it, prev = 0, None
    while True:
        a = assign()
        members = {}
        for pid, (cid, d) in a.items():
            members.setdefault(cid, []).append(pid)
        metric = sum(sum(a[p][1] for p in m) / len(m) for m in members.values())
        moved = None if it == 0 else sum(1 for p in a if a[p][0] != prev[p][0])
        if (it > 0 and moved == 0) or it == max_iterations:
            return metric, it, a
        cents = {cid: [sum(points[p][j] for p in m) / len(m) for j in range(len(init[0]))]
                 for cid, m in members.items()}
        prev, it = a, it + 1


def _fixture(spark, n=300, d=3, seed=7, parts=3):
    rnd = random.Random(seed)
    centers = [[0, 0, 0], [5, 5, 5], [0, 6, -3]]
    pts = {i: [c + rnd.gauss(0, 1.2) for c in centers[i % 3][:d]] for i in range(n)}
    df = spark.createDataFrame([(i, v) for i, v in pts.items()], "id long, features array<double>")
    return pts, df.repartition(parts)


def test_loop_matches_brute_force(spark):
    pts, df = _fixture(spark)
    prepared, d, _ = L.prepare_points(df, "features", "id")
    init = [pts[i] for i in range(4)]
    for max_it in (0, 1, 3, 50):
        res = L.lloyd(prepared, 4, max_it, init=L.Centroids.of(init))
        metric, iterations, a = brute_lloyd(pts, init, max_it)
        assert res.iterations == iterations
        assert res.metric == pytest.approx(metric, rel=1e-12)
        got = {r.id: r.cid for r in res.assignment().collect()}
        assert got == {p: c for p, (c, _) in a.items()}


@pytest.mark.parametrize("k", [2, 6])
@pytest.mark.parametrize("bad", [None, [1.0], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 1.0, 2.0]])
def test_invalid_vectors_fail_or_are_counted(spark, k, bad):
    pts, _ = _fixture(spark, n=40)
    rows = [*pts.items(), (1000, bad)]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    with pytest.raises(ValueError):
        L.prepare_points(df, "features", "id")
    with pytest.raises(ValueError, match="1 rows"):
        L.prepare_points(df, "features", "id", dims=3)
    prepared, d, dropped = L.prepare_points(df, "features", "id", dims=3, on_invalid="drop")
    assert (d, dropped, prepared.count()) == (3, 1, 40)
    res = L.lloyd(prepared, k, 30, init="lowest")
    metric, iterations, _ = brute_lloyd(pts, [pts[i] for i in range(k)], 30)
    assert (res.iterations, res.metric) == (iterations, pytest.approx(metric, rel=1e-12))
    out = L.LloydModel(res, "features", "id").transform(df)
    assert out.count() == 41
    assert [r.id for r in out.where("cid IS NULL AND dist IS NULL").collect()] == [1000]


def test_unprepared_vectors_fail_in_the_kernel(spark):
    df = spark.createDataFrame([(0, [1.0, None])], "id long, _v array<double>")
    for k in (2, 6):
        with pytest.raises(Exception, match="non-finite"):
            L.assign(df, L.Centroids.of([[float(i), 0.0] for i in range(k)])).collect()


def test_wide_vectors(spark):
    wide = [[float((i * j) % 7) for j in range(1536)] for i in range(12)]
    df = spark.createDataFrame([(i, i % 3, v) for i, v in enumerate(wide)], "id long, k int, features array<double>")
    got = {r.k: r["sum"] for r in vector_sum_by_key(df, "k", "features").collect()}
    for k in range(3):
        assert got[k] == [sum(wide[i][j] for i in range(k, 12, 3)) for j in range(1536)]
    d = df.select(euclidean("features", F.array_repeat(F.lit(0.0).cast("double"), 1536)).alias("d")).collect()
    assert d[1].d == pytest.approx(sum(x * x for x in wide[1]) ** 0.5)
    prepared, *_ = L.prepare_points(df, "features", "id")
    up = L.update_centroids(prepared, L.init_centroids(prepared, 2, "lowest")).collect()
    assert sum(r.n for r in up) == 12 and all(len(r.center) == 1536 for r in up)


def test_moved_points_shuffle_nothing(spark):
    _, df = _fixture(spark, n=50)
    prepared, *_ = L.prepare_points(df, "features", "id")
    plan = L.moved_points(prepared, L.Centroids.of([[0.0] * 3]), L.Centroids.of([[1.0] * 3]))._jdf.queryExecution()
    assert "Join" not in plan.executedPlan().toString()


def test_ties_go_to_lowest_cid_and_duplicates(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0])],
                               "id long, features array<double>")
    prepared, *_ = L.prepare_points(df, "features", "id")
    cents = L.Centroids.of([[2.0, 0.0], [0.0, 0.0]], cids=[5, 3])
    got = {r.id: r.cid for r in L.assign(prepared, cents).collect()}
    # point 1 and 2 are equally far from both: first in centroid order wins
    assert got == {0: 3, 1: 5, 2: 5}


def test_k_equals_one_and_k_equals_n(spark):
    pts, df = _fixture(spark, n=12)
    prepared, *_ = L.prepare_points(df, "features", "id")
    one = L.lloyd(prepared, 1, 5, init=L.Centroids.of([pts[0]]))
    assert one.iterations == 1  # second pass: nothing can move
    alln = L.lloyd(prepared, 12, 5, init="lowest")
    assert alln.metric == pytest.approx(0.0) and alln.iterations == 1


def test_empty_cluster_drop_or_keep(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, [0.1]), (2, [10.0])], "id long, features array<double>")
    prepared, *_ = L.prepare_points(df, "features", "id")
    init = L.Centroids.of([[0.0], [10.0], [100.0]])
    st = L.lloyd_pass(prepared, init)
    assert st.update(init, "drop").cids == (0, 1)
    kept = st.update(init, "keep")
    assert kept.cids == (0, 1, 2) and kept.centers[2] == (100.0,)
    res = L.lloyd(prepared, 3, 10, init=init)
    assert res.centroids.k == 2


def test_identical_points_and_converged_start(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(20)], "id long, features array<double>")
    prepared, *_ = L.prepare_points(df, "features", "id")
    res = L.lloyd(prepared, 2, 10, init="lowest")
    assert res.iterations == 1 and res.metric == 0.0


def test_sse_never_increases_and_partitioning_invariant(spark):
    pts, df = _fixture(spark, n=400, parts=2)
    prepared, *_ = L.prepare_points(df, "features", "id")
    init = L.Centroids.of([pts[i] for i in range(5)])
    res = L.lloyd(prepared, 5, 30, init=init)
    costs = [h["cost"] for h in res.history]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    other, *_ = L.prepare_points(df.repartition(5), "features", "id")
    res2 = L.lloyd(other, 5, 30, init=init)
    assert res2.iterations == res.iterations and res2.metric == pytest.approx(res.metric, abs=1e-9)


def test_restarts_in_lockstep_equal_separate_runs(spark):
    pts, df = _fixture(spark, n=200)
    prepared, *_ = L.prepare_points(df, "features", "id")
    runs = {r.seed: (r.metric, r.iterations) for r in L.restarts(prepared, 3, 15, n=3, base_seed=10).collect()}
    for seed in (10, 11, 12):
        one = L.lloyd(prepared, 3, 15, init="random", seed=seed)
        assert runs[seed][1] == one.iterations
        assert runs[seed][0] == pytest.approx(one.metric, rel=1e-12)


def test_negative_max_iterations_rejected(spark):
    _, df = _fixture(spark, n=10)
    prepared, *_ = L.prepare_points(df, "features", "id")
    with pytest.raises(ValueError):
        L.lloyd(prepared, 2, -1, init="lowest")


def test_separate_operators_agree_with_pass_stats(spark):
    pts, df = _fixture(spark, n=150)
    prepared, d, _ = L.prepare_points(df, "features", "id")
    c0 = L.Centroids.of([pts[i] for i in range(3)])
    st = L.lloyd_pass(prepared, c0)
    a = L.assign(prepared, c0)
    metric = L.intra_cluster_distance(a).collect()[0].metric
    cost = L.kmeans_cost(a).collect()[0].cost
    assert metric == pytest.approx(st.metric, rel=1e-12) and cost == pytest.approx(st.cost, rel=1e-12)
    upd = {r.cid: r.center for r in L.update_centroids(prepared, c0).collect()}
    new = st.update(c0)
    for cid, center in zip(new.cids, new.centers):
        assert upd[cid] == pytest.approx(list(center), rel=1e-12)
    c1 = new
    moved = L.moved_points(prepared, c1, c0).count()
    assert moved == L.lloyd_pass(prepared, c1, c0).moved


def test_estimator_api(spark):
    pts, df = _fixture(spark, n=120)
    model = L.LloydKMeans(3, 30, init="lowest").fit(df, "features", "id")
    out = model.transform(df)
    assert out.columns == ["id", "cid", "dist"] and out.count() == 120
    assert model.centers(spark).count() == model.centroids.k
    assert model.history(spark).count() == model.iterations + 1
    metric, iterations, _ = brute_lloyd(pts, [pts[i] for i in range(3)], 30)
    assert model.iterations == iterations and model.metric == pytest.approx(metric, rel=1e-12)


def test_large_centroid_sets_are_broadcast(spark, monkeypatch):
    pts, df = _fixture(spark, n=150)
    prepared, *_ = L.prepare_points(df, "features", "id")
    init = L.Centroids.of([pts[i] for i in range(3)])
    small = L.lloyd(prepared, 3, 10, init=init)
    monkeypatch.setattr(L, "SHIP_BROADCAST_BYTES", 0)
    big = L.lloyd(prepared, 3, 10, init=init)
    assert (big.iterations, big.metric) == (small.iterations, small.metric)
    a = {r.id: r.cid for r in L.assign(prepared, big.centroids).collect()}
    assert a == {r.id: r.cid for r in small.assignment().collect()}


def test_empty_input_is_a_clear_error(spark):
    empty = spark.createDataFrame([], "id long, features array<double>")
    prepared, *_ = L.prepare_points(empty, "features", "id", dims=3)
    with pytest.raises(ValueError, match="no points"):
        L.lloyd(prepared, 2, 5, init="lowest")


def test_vectors_are_checked_in_one_job(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)] + [(20, None), (21, [float("nan"), 1.0])],
                               "id long, features array<double>")
    tracker = spark.sparkContext.statusTracker()
    counts = []
    for dims in (None, 2):
        group = f"checks-{dims}"
        spark.sparkContext.setJobGroup(group, "checks")
        points, d, dropped = L.prepare_points(df, dims=dims, on_invalid="drop")
        counts.append(len(tracker.getJobIdsForGroup(group)))
        assert (d, dropped) == (2, 2)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one aggregate: its partial stage and its last one, as adaptive execution submits them
    assert counts[0] == counts[1] <= 2, counts
    with pytest.raises(ValueError, match="different lengths"):
        L.prepare_points(df.union(spark.createDataFrame([(30, [1.0])], df.schema)))
    with pytest.raises(ValueError, match="no non-null"):
        L.prepare_points(df.where("features IS NULL"))
