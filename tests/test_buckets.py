"""Bucketed layout: the same rows, and repeated joins without an exchange."""

import pytest
from pyspark.sql import functions as F

from kestrel.plans import QUERIES
from kestrel.sources import buckets
from kestrel.sources.tables import load_table
from support import SF001


@pytest.mark.parametrize("key", ["bucketed_like_join", "bucketed_customer_totals"])
def test_no_exchange_on_the_customer_key(spark, key):
    df = QUERIES[key](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert df.count() > 0


def _tables(spark):
    return {t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")}


def test_written_once_for_both_queries(spark):
    QUERIES["bucketed_like_join"](spark, SF001)
    before = _tables(spark)
    for key in ("bucketed_customer_totals", "bucketed_like_join"):
        QUERIES[key](spark, SF001)
    assert before and _tables(spark) == before


def test_same_rows_nulls_and_empty(spark):
    df = load_table(spark, SF001, "orders").select(
        F.when(F.col("o_custkey") % 10 > 0, F.col("o_custkey")).alias("k"), "o_orderkey")
    back = spark.table(buckets.write_bucketed(df, "k", 3))
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert len(back.inputFiles()) <= 3
    assert spark.table(buckets.write_bucketed(df.limit(0), "k", 3)).count() == 0
    with pytest.raises(ValueError):
        buckets.write_bucketed(df, "k", 0)
