"""Plan shape: pushdown, pruning, no cartesian product, bounded broadcasts, skew splitting."""

from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from support import SF001
from kestrel.operators import lloyd as L
from kestrel.operators.ordering import with_row_index


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_like_prefix_and_columns_reach_the_scan(spark):
    plan = _plan(entry_mod.queries()["sql_like_join"](spark, SF001))
    assert "StringStartsWith(c_mktsegment,B)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_count_distinct_combines_before_each_shuffle(spark):
    plan = _plan(entry_mod.queries()["sql_sum_distinct"](spark, SF001))
    assert plan.count("partial_sum") >= 1 and "Expand" not in plan


def test_lloyd_pass_scores_without_a_join(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    pts, *_ = L.prepare_points(emb, "embedding", "vec_id")
    cents = L.init_centroids(pts, 3, "lowest")
    plan = _plan(L.assign(pts, cents))
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_row_index_splits_a_hot_key(spark):
    # one key value holds a third of the rows
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    out = with_row_index(df, "k", partitions=6)
    sizes = Counter(r.p for r in out.select(F.spark_partition_id().alias("p")).collect())
    assert max(sizes.values()) < 1000 + 200  # the hot key is cut, not kept whole
    assert sorted(r.row_index for r in out.collect()) == list(range(3000))


def test_row_index_broadcasts_only_the_offsets(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    plan = _plan(with_row_index(df, "k", partitions=4))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_shuffle_of_points_past_the_broadcast_threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("lloyd_moved", "euclidean_distance"):
            plan = _plan(entry_mod.queries()[key](spark, SF001))
            assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan, key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_runtime_filter_reaches_the_orders(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry_mod.queries()["runtime_filter_join"](spark, SF001)
        plain = entry_mod.queries()["sql_like_join"](spark, SF001)
        plan = _plan(df)
        assert "might_contain" in plan and "bloom_filter_agg" in plan and "SortMergeJoin" in plan, plan
        assert "might_contain" not in _plan(plain)  # the session given keeps its settings
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
