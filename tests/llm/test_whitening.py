"""Embedding whitening against plain eigenvectors, and its exact parts on small cases."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from kestrel.llm import queries as Q
from kestrel.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def run(spark, path):
    return Q.op11_embedding_whitening(spark, path).toPandas().sort_values(["vec_id", "component"], kind="stable")


def query_dir(spark, tmp_path, rows, kind="float"):
    df = spark.createDataFrame(rows, SCHEMA.replace("float", kind)).selectExpr("*", "1 AS n", "'q' AS y", "2 AS component")
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def integers(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000


def check(got, ids, vectors):
    """``ids`` ascending; eigenvalues well apart."""
    x = integers(vectors)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = min(16, int((values > values.sum() * 1e-12).sum()))
    assert got.vec_id.tolist() == [i for i in ids for _ in range(k)]
    assert (got.n == n).all() and (got.identity_error <= 1e-9).all()
    assert got.deviation.tolist() == [v for v in ((n * x - sums) ** 2).sum(1).tolist() for _ in range(k)]
    np.testing.assert_allclose(got.explained.to_numpy().reshape(-1, k)[0], (values / values.sum())[:k], rtol=1e-9)
    want = (x - sums / n) @ vecs[:, :k] / np.sqrt(values[:k])
    np.testing.assert_allclose(np.abs(got.whitened.to_numpy().reshape(-1, k)), np.abs(want), atol=1e-8)


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{path}/embeddings.parquet").orderBy("vec_id").toPandas()
    check(run(spark, path), table.vec_id.tolist(), np.stack(table.embedding))


def test_edge_rows(spark, tmp_path):
    random.seed(5)
    good = [(i, [random.gauss(0, s + 1) for s in range(5)], 1) for i in range(60)]
    bad = [(100, None, 1), (101, [1.0, None, 2.0, 3.0, 4.0], 1), (102, [float("nan")] * 5, 1), (103, [1.0, float("inf"), 0.0, 0.0, 0.0], 1),
           (104, [1.0, -float("inf"), 0.0, 0.0, 0.0], 1), (105, [], 1), (106, [1.0, 2.0], None)]
    again = [(200 + i, good[7][1], None) for i in range(40)]
    got = run(spark, query_dir(spark, tmp_path, good + bad + again))
    check(got, [r[0] for r in good + again], [r[1] for r in good + again])


def test_null_ids_and_huge_entries(spark, tmp_path):
    rows = [(None, [1e300, 1.0, 2.0], 1), (1, [-1e300, 5.0, 1.0], 1), (2, [3.0, 1e15, 0.5], 1), (3, [0.0, 0.0, 9.0], 1)]
    got = Q.op11_embedding_whitening(spark, query_dir(spark, tmp_path, rows, "double")).collect()
    assert len(got) == 4 * 3 and {r["vec_id"] for r in got} == {None, 1, 2, 3}
    assert all(r["identity_error"] < 1e-4 and math.isfinite(r["whitened"]) for r in got)
    assert any(r["deviation"] is None for r in got)


def test_equal_eigenvalues_and_missing_rank(spark, tmp_path):
    # +-e_i in three of four dimensions: one eigenvalue, three times, and a zero
    rows = [(2 * i + s, [float((1 - 2 * s) * (j == i)) for j in range(4)], 1) for i in range(3) for s in range(2)]
    got = run(spark, query_dir(spark, tmp_path, rows))
    assert len(got) == 6 * 3 and (got.identity_error < 1e-12).all()
    np.testing.assert_allclose(got.explained, 1 / 3, rtol=1e-12)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1)] * 3, [(1, None, 1)]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    got = Q.op11_embedding_whitening(spark, query_dir(spark, tmp_path, rows))
    assert got.count() == 0 and got.columns[:2] == ["vec_id", "component"]


def test_gram_of_large_entries():
    random.seed(1)
    y = [[random.randint(-(1 << 62), 1 << 62) >> random.choice((0, 30, 60)) for _ in range(4)] for _ in range(700)]
    got = W.gram(np.array(y, np.int64))
    assert got.tolist() == [[sum(r[i] * r[j] for r in y) for j in range(4)] for i in range(4)]


def newton_polynomial(m):
    """det(t I - m) by Faddeev and LeVerrier, in fractions."""
    d = len(m)
    a, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        a = [[sum(m[i][x] * a[x][j] for x in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(m[i][x] * a[x][i] for i in range(d) for x in range(d)) / k)
    return [int(x) for x in reversed(c)]


def test_polynomial_and_roots(spark):
    random.seed(2)
    for d, size in ((1, 9), (2, 10 ** 12), (5, 3), (9, 10 ** 6)):
        b = [[random.randint(-size, size) for _ in range(d)] for _ in range(d)]
        m = [[sum(x * y for x, y in zip(r, s)) for s in b] for r in b]
        poly = W.characteristic_polynomial(spark, m)
        assert poly == newton_polynomial(m)
        got = W.largest_roots(poly, d)
        want = np.linalg.eigvalsh(np.array(m, float))[::-1]
        found = [float(r) for r, c in got for _ in range(c)]
        np.testing.assert_allclose(found, want[:len(found)], rtol=1e-6, atol=1e-6 * want[0])
        for root, count in got:
            for v in W.null_vectors(m, root, count):
                v = [float(x) for x in v]
                moved = [sum(a * x for a, x in zip(row, v)) for row in m]
                np.testing.assert_allclose(moved, [float(root) * x for x in v], atol=1e-9 * float(got[0][0]))


def test_close_roots_are_told_apart():
    # (t - 1000) (t - 1001) (t - 1001) t, and two roots 2 ** -20 apart
    poly = [0, -1000 * 1001 ** 2, 1001 ** 2 + 2 * 1000 * 1001, -3002, 1]
    assert W.largest_roots(poly, 3) == [(Fraction(1001), 2), (Fraction(1000), 1)]
    near = W.largest_roots([5 ** 2 * (1 << 40) - 25, -10 * (1 << 40), 1 << 40], 2)
    assert [c for _, c in near] == [1, 1] and float(near[0][0] - near[1][0]) == pytest.approx(10 / (1 << 20), rel=1e-6)
