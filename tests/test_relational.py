"""Relational operators, evaluation aggregates, report and ordering on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel.operators import metrics, relational as rel, report
from kestrel.operators.ordering import lowest_k, sample_k, with_row_id, with_row_index


@pytest.fixture
def people(spark):
    rows = [(1.0, dt.date(2010, 7, 1), "Bob"), (2.0, dt.date(2010, 7, 9), "Bob"),
            (3.0, dt.date(2011, 3, 1), "Ann"), (4.0, dt.date(2012, 7, 4), "Bea"),
            (5.0, dt.date(2012, 8, 4), "Cid"), (6.0, None, "Dan")]
    return spark.createDataFrame(rows, "cid double, startDate date, name string")


def test_month_filter_then_distinct(people):
    got = sorted(r.name for r in rel.distinct_in_month(people, "startDate", 7, ["name"]).collect())
    assert got == ["Bea", "Bob"]  # Bob twice in July counted once; Ann (March) out


def test_like_prefix_join(spark, people):
    orders = spark.createDataFrame([(1.0, 250), (1.0, 250), (4.0, 10), (5.0, 3)], "cid double, total int")
    names = rel.starts_with("name", "B")
    got = rel.inner_join(people.filter(names), orders, "cid", "cid").select(people["cid"], orders["total"]).collect()
    assert sorted(tuple(r) for r in got) == [(1.0, 250), (1.0, 250), (4.0, 10)]


def test_sum_and_count_distinct_with_nulls(spark):
    rows = [(1.0, 5), (1.0, 5), (1.0, 7), (2.0, None), (2.0, None), (3.0, 1), (3.0, None)]
    df = spark.createDataFrame(rows, "cid double, total int")
    got = {r.cid: (r.tot, r.cnt) for r in rel.group_sum_count_distinct(df, "cid", "total").collect()}
    assert got == {1.0: (17, 2), 2.0: (None, 0), 3.0: (1, 1)}
    assert {r.cid: r.tot for r in rel.group_sum(df, "cid", "total").collect()} == \
        {1.0: 17, 2.0: None, 3.0: 1}


def test_group_avg_all_numeric_only(spark):
    df = spark.createDataFrame([("a", 1, 2.0, "x"), ("a", 3, 4.0, "y")], "k string, i int, d double, s string")
    out = rel.group_avg_all(df, "k")
    assert out.columns == ["k", "avg_i", "avg_d"]
    assert tuple(out.collect()[0]) == ("a", 2.0, 3.0)


def test_binarize_and_not_null_flag(spark):
    df = spark.createDataFrame([("normal.",), ("smurf.",), (None,)], "label string")
    got = [tuple(r) for r in df.select(rel.binarize("label", "normal."),
                                       rel.not_null_flag("label")).collect()]
    assert got == [(1.0, 1), (0.0, 1), (None, 0)]


def test_count_where_one_pass(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)], "y double, prediction double")
    r = rel.count_where(df, {"neg": F.col("y") == 0, "neg_hit": (F.col("y") == 0) & (F.col("prediction") == 0)}).collect()[0]
    assert (r.neg, r.neg_hit) == (2, 1)


def test_accuracy_and_recall_edge_cases(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (0.0, 0.0), (None, 0.0)], "y double, prediction double")
    acc = metrics.accuracy(df).collect()[0]
    assert (acc.hits, acc.total) == (2, 4) and acc.accuracy == 0.5
    rec = {r["class"]: (r.support, r.hits, r.recall) for r in metrics.class_recall(df).collect()}
    assert rec == {0.0: (3, 2, 2 / 3), 1.0: (0, 0, None)}  # absent class -> NULL recall
    empty = spark.createDataFrame([], "y double, prediction double")
    e = metrics.accuracy(empty).collect()[0]
    assert (e.hits, e.total, e.accuracy) == (0, 0, None)


def test_mean_stddev_is_population(spark):
    import numpy as np
    vals = [1.0, 2.0, 4.0, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = metrics.mean_stddev_pop(df, "v").collect()[0]
    assert r.mean == pytest.approx(np.mean(vals)) and r.std == pytest.approx(np.std(vals))


def test_cluster_percentages_two_forms(spark):
    rows = [("a", 0), ("a", 0), ("b", 0), (None, 0), ("a", 1), ("c", 2)]
    df = spark.createDataFrame(rows, "label string, prediction int")
    w = {(r.label, r.prediction): r.percentage for r in report.cluster_label_pct(df).collect()}
    j = {(r.label, r.prediction): r.percentage for r in report.cluster_label_pct_join(df).collect()}
    assert w == j
    assert w[("a", 0)] == 50.0 and w[(None, 0)] == 25.0 and w[("a", 1)] == 100.0
    sizes = {r.prediction: r["count"] for r in report.cluster_sizes(df).collect()}
    assert sizes == {0: 4, 1: 1, 2: 1}


def test_row_index_is_exactly_consecutive(spark):
    rows = [(k % 37, f"v{k}") for k in range(1000)]  # many ties on the key
    df = spark.createDataFrame(rows, "k int, v string").repartition(7)
    out = with_row_index(df, "k", partitions=5).collect()
    assert sorted(r.row_index for r in out) == list(range(1000))
    ordered = sorted(out, key=lambda r: r.row_index)
    assert [r.k for r in ordered] == sorted(r.k for r in out)


def test_row_id_unique_and_sample_distinct(spark):
    df = spark.range(0, 500, 1, 4).withColumnRenamed("id", "x")
    ids = [r.row_id for r in with_row_id(df).collect()]
    assert len(set(ids)) == 500
    s1 = [r.x for r in sample_k(df, 5, seed=3).collect()]
    s2 = [r.x for r in sample_k(df, 5, seed=3).collect()]
    assert len(set(s1)) == 5 and s1 == s2
    assert [r.x for r in lowest_k(df, 3, "x").collect()] == [0, 1, 2]


def test_vector_aggregates(spark):
    from kestrel.operators.vectors import explode_vector, vector_mean_by_key, vector_sum_by_key
    rows = [(0, [1.0, 2.0]), (0, [3.0, 4.0]), (1, [5.0, -1.0])]
    df = spark.createDataFrame(rows, "k int, v array<float>")
    mean = {r.k: r.mean for r in vector_mean_by_key(df, "k", "v").collect()}
    assert mean == {0: [2.0, 3.0], 1: [5.0, -1.0]}
    sums = {r.k: r["sum"] for r in vector_sum_by_key(df, "k", "v").collect()}
    assert sums == {0: [4.0, 6.0], 1: [5.0, -1.0]}
    ex = explode_vector(df.filter("k = 1"), "v").collect()
    assert [(r.pos, r.value) for r in ex] == [(0, 5.0), (1, -1.0)]


def test_euclidean_zips_to_shorter(spark):
    from kestrel.functions.arrays import euclidean
    df = spark.createDataFrame([([0.0, 3.0, 9.0], [4.0, 0.0, 9.0]), ([1.0, 1.0], [1.0, 1.0, 5.0])],
                               "a array<double>, b array<double>")
    hof = [r[0] for r in df.select(euclidean("a", "b")).collect()]
    assert hof == [5.0, 0.0]


def test_recall_on_empty_input_and_name_in_two_months(spark, people):
    empty = spark.createDataFrame([], "y double, prediction double")
    rows = sorted(tuple(r) for r in metrics.class_recall(empty).collect())
    assert rows == [(0.0, 0, 0, None), (1.0, 0, 0, None)]
    more = people.union(spark.createDataFrame([(7.0, dt.date(2013, 7, 2), "Cid")], people.schema))
    got = sorted(r.name for r in rel.distinct_in_month(more, "startDate", 7, ["name"]).collect())
    assert got == ["Bea", "Bob", "Cid"]  # Cid also has an August row; counted once


def test_hash_sample_is_partitioning_independent(spark):
    from kestrel.operators.ordering import hash_sample_k
    df = spark.range(0, 3000).select("id")
    a = [r.id for r in hash_sample_k(df, 7, seed=5).collect()]
    b = [r.id for r in hash_sample_k(df.repartition(9), 7, seed=5).collect()]
    c = [r.id for r in hash_sample_k(df, 7, seed=6).collect()]
    assert a == b and len(set(a)) == 7 and a != c


def test_group_avg_all_matches_spark_avg_naming_and_columns(spark):
    df = spark.createDataFrame([(0, "a", 1.0), (0, "b", 3.0), (1, "a", 5.0)],
                               "prediction int, label string, pct double")
    ours = rel.group_avg_all(df, "label", "prediction")
    theirs = df.groupBy("label", "prediction").avg()
    assert [c.replace("avg_", "avg(") + ")" if c.startswith("avg_") else c for c in ours.columns] \
        == theirs.columns
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_row_ids_ascend_and_are_not_all_consecutive(spark):
    from kestrel.operators.ordering import with_row_id

    df = with_row_id(spark.range(0, 1000, 1, 4).withColumnRenamed("id", "k"), "p_id")
    ids = [r.p_id for r in df.orderBy("k").collect()]
    assert all(a < b for a, b in zip(ids, ids[1:])) and ids[-1] - ids[0] > 999
    assert sum(b - a > 1 for a, b in zip(ids, ids[1:])) == 3  # only between tasks
