"""Properties of the keys without an oracle and of the indexer."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from support import SF001
from kestrel.plans import ORACLES, QUERIES
from kestrel.operators import classify, cluster_ml, features
from kestrel.operators.lloyd import Centroids, assign, prepare_points
from kestrel.sources.generate import gaussian_points, range_source

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))  # kestrel/llm has tests of its own


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_keys_run(spark, key):
    df = entry_mod.queries()[key](spark, SF001)
    n = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert key == "gen_gaussian" and df.count() == n and df.where("label NOT BETWEEN 0 AND 2").isEmpty()


def test_strong_regularization_gives_intercept_only(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    li = classify.label_binary(li, "l_returnflag", "R")
    model = classify.fit(li, ["l_quantity", "l_discount", "l_tax"], ["l_linestatus"], "y",
                         max_iter=100, reg_param=10.0)
    lr = model.stages[-1]
    assert all(w == 0.0 for w in lr.coefficients.toArray())
    p = li.agg(F.avg("y")).collect()[0][0]
    assert lr.intercept == pytest.approx(math.log(p / (1 - p)), abs=1e-4)


def test_scores_are_probabilities_and_threshold(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").withColumn(
        "y", (F.col("l_quantity") > 25).cast("float"))
    train, test = li.filter(F.col("l_orderkey") < 1000), li.filter(F.col("l_orderkey") >= 1000)
    model = classify.fit(train, ["l_quantity", "l_extendedprice"], (), "y", max_iter=10)
    scored = classify.score(model, test)
    rows = scored.collect()
    assert len(rows) == test.count()
    for r in rows:
        assert sum(r.probability) == pytest.approx(1.0)
        assert r.prediction == (1.0 if r.probability[1] > 0.5 else 0.0)
    coef = classify.coefficients(model, spark, ["l_quantity", "l_extendedprice"]).collect()
    assert [r.feature for r in coef] == ["l_quantity", "l_extendedprice", "(intercept)"]


def test_string_indexer_ties_nulls_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "t string")
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("zzz",), (None,)], "t string")
    out = features.index_columns(train, test, ["t"])
    got = [r.t for r in out.collect()]
    # c most frequent -> 0; a, b tie -> alphabetical; unseen and NULL -> numLabels (3)
    assert got == [1.0, 2.0, 0.0, 3.0, 3.0]


def test_assembler_keeps_order(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    out = features.assemble(df, ["c", "a", "b"], as_array=True).collect()[0]
    assert out.features == [3.0, 1.0, 2.0]


def test_mllib_kmeans_properties(spark):
    emb = cluster_ml.with_vector(spark.read.parquet(f"{SF001}/embeddings.parquet"), "embedding")
    m1, m2 = cluster_ml.fit(emb, 3, seed=1), cluster_ml.fit(emb, 3, seed=1)
    assert cluster_ml.training_cost(m1) == pytest.approx(cluster_ml.training_cost(m2))
    pred = cluster_ml.predict(m1, emb, keep=["vec_id", "embedding"])
    sizes = pred.groupBy("prediction").count().collect()
    assert sum(r["count"] for r in sizes) == emb.count()
    pts, *_ = prepare_points(emb.drop("features"), "embedding", "vec_id")
    mine = {r.id: r.cid for r in assign(pts, Centroids.of(m1.clusterCenters())).collect()}
    assert all(mine[r.vec_id] == r.prediction for r in pred.collect())
    cost = cluster_ml.cost(m1, emb.drop("features"), "embedding", "vec_id").collect()[0].cost
    assert cost == pytest.approx(cluster_ml.training_cost(m1), rel=1e-6)


def test_gaussian_generator(spark):
    n, s, k = 20000, 2.0, 3
    df = gaussian_points(spark, n, dims=4, k=k, partitions=4, std=s, seed=1)
    stats = df.agg(F.count("*").alias("n"), F.avg("x0").alias("m"), F.stddev_pop("x1").alias("sd"),
                   F.min("label").alias("lo"), F.max("label").alias("hi")).collect()[0]
    assert stats.n == n
    assert abs(stats.m - 10.0) < 4 * s / math.sqrt(n)
    assert stats.sd == pytest.approx(s, rel=0.05)
    assert (stats.lo, stats.hi) == (0, k - 1)
    again = gaussian_points(spark, n, dims=4, k=k, partitions=4, std=s, seed=1)
    assert df.orderBy("id").limit(50).collect() == again.orderBy("id").limit(50).collect()


def test_range_source(spark):
    assert [r.id for r in range_source(spark, 5).collect()] == [0, 1, 2, 3, 4]


def test_learnable_target_is_learned(spark):
    acc = entry_mod.queries()["logreg_accuracy"](spark, SF001).collect()[0]
    assert acc.total > 0 and acc.accuracy > 0.99


def test_distributed_indexer_matches_mllib(spark):
    ev = spark.read.parquet(f"{SF001}/lineitem.parquet")
    train, test = ev.filter("l_linenumber > 1"), ev.filter("l_linenumber <= 2")
    cols = ["l_returnflag", "l_linestatus"]
    a = features.index_columns(train, test, cols).select("l_orderkey", "l_linenumber", *cols)
    b = features.index_by_frequency(train, test, cols).select("l_orderkey", "l_linenumber", *cols)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    small_train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "t string")
    small_test = spark.createDataFrame([("a",), ("b",), ("c",), ("zzz",), (None,)], "t string")
    got = [r.t for r in features.index_by_frequency(small_train, small_test, ["t"]).collect()]
    assert sorted(got) == sorted([1.0, 2.0, 0.0, 3.0, 3.0])
