"""Fixed-point sums: same bits however rows lie, right to the stated precision."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from kestrel.operators import fixed_sums as S


def _bits(x):
    return struct.pack("<d", x)


@pytest.fixture(scope="module")
def vectors(spark):
    rnd = random.Random(8)
    rows = [(i, None if i % 50 == 7 else i % 3, [rnd.gauss(0, 10.0 ** rnd.randint(-6, 6)) for _ in range(5)]) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id long, k long, v array<double>")


@pytest.mark.parametrize("mean", [False, True])
def test_same_bits_on_any_partitioning(spark, vectors, mean):
    rows, df = vectors
    seen = set()
    for n in (1, 4, 64):
        got = S.vector_by_key(df.orderBy(F.rand(n)).repartition(n), "k", "v", mean=mean).collect()
        seen.add(tuple(sorted((str(r.k), *map(_bits, r["sum"])) for r in got)))
    assert len(seen) == 1
    top = max(abs(x) for _, _, v in rows for x in v)
    for r in got:
        own = [v for _, k, v in rows if k == r.k]
        for i, x in enumerate(r["sum"]):
            want = math.fsum(v[i] for v in own) / (len(own) if mean else 1)
            assert abs(x - want) <= top * 2.0 ** -52 * (1 if mean else len(own))


def test_metric_has_the_same_bits(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.randrange(5), rnd.random() * 9) for _ in range(4000)], "cid int, dist double")
    seen = {_bits(S.intra_cluster_distance(df.orderBy(F.rand(n)).repartition(n)).first()[0]) for n in (1, 4, 64)}
    assert len(seen) == 1


def test_edges(spark):
    df = spark.createDataFrame([("a", [1.0, None]), ("a", [2.5, -4.0]), ("b", [0.0, None]), ("c", None), ("d", [])],
                               "k string, v array<double>")
    assert {r.k: r["sum"] for r in S.vector_by_key(df, "k", "v").collect()} == {"a": [3.5, -4.0], "b": [0.0, None]}
    assert {r.k: r["sum"] for r in S.vector_by_key(df, "k", "v", mean=True).collect()} == {"a": [1.75, -4.0], "b": [0.0, None]}
    assert S.vector_by_key(df.limit(0), "k", "v").count() == 0
    zeros = spark.createDataFrame([("a", [0.0])] * 3, "k string, v array<float>")
    assert S.vector_by_key(zeros, "k", "v").first()["sum"] == [0.0]
    for bad in (float("nan"), float("inf"), -float("inf")):
        with pytest.raises(ValueError):
            S.vector_by_key(spark.createDataFrame([("a", [1.0, bad])], "k string, v array<double>"), "k", "v")


def test_large_and_small_magnitudes(spark):
    for x in (1e300, 3e-300, 2.0 ** 52, 1 / 3):
        df = spark.createDataFrame([(x,)] * 7, "x double")
        got = df.agg(S.fixed_sum(F.col("x"), S.scale_bits(df, F.abs("x")))).first()[0]
        assert math.isclose(got, 7 * x, rel_tol=1e-12)
