"""Relational and SQL queries of the reference, on the driver's tables.

Mapping of the reference's inputs: people -> ``customer`` (cid = c_custkey,
name -> c_mktsegment for the prefix test), orders -> ``orders`` (cid =
o_custkey, total = o_totalprice as INT, start date -> o_orderdate),
classifier output -> ``labels`` (y = quality, prediction = toxic).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import to_type
from ..operators import metrics, relational as rel
from ..session import with_runtime_filters
from ..sources.buckets import layout
from ..sources.tables import load_table, register_tables
from .registry import query

JULY = 7  # fixed value: the month the reference's queries select

BUILDING_TOTALS_SQL = """
WITH segment AS (SELECT c_custkey FROM customer WHERE c_mktsegment LIKE 'B%')
SELECT segment.c_custkey AS cid, orders.o_totalprice AS total
FROM segment JOIN orders ON orders.o_custkey = segment.c_custkey
"""


@query("sql_like_join", oracle=BUILDING_TOTALS_SQL)
def sql_like_join(spark, data_dir):
    """Join and LIKE through ``spark.sql``."""
    register_tables(spark, data_dir, ("customer", "orders"))
    return spark.sql(BUILDING_TOTALS_SQL)


@query("runtime_filter_join", oracle=BUILDING_TOTALS_SQL)
def runtime_filter_join(spark, data_dir):
    """The join with LIKE; above the broadcast limit, a Bloom filter of the
    customers left by the filter rules orders out before they are shuffled."""
    own = with_runtime_filters(spark)
    register_tables(own, data_dir, ("customer", "orders"))
    return own.sql(BUILDING_TOTALS_SQL)


# Buckets of the layout by customer: at 100 TB some hundreds of MB each want thousands.
CUSTOMER_BUCKETS = 16


def _by_customer(spark, data_dir):
    tables = {"customer": (load_table(spark, data_dir, "customer"), "c_custkey"),
              "orders": (load_table(spark, data_dir, "orders"), "o_custkey")}
    both = layout(spark, f"customer:{data_dir}", tables, CUSTOMER_BUCKETS)
    return both["customer"], both["orders"]


@query("bucketed_like_join", oracle=BUILDING_TOTALS_SQL)
def bucketed_like_join(spark, data_dir):
    """The join with LIKE over tables bucketed by customer, without an exchange."""
    customer, orders = _by_customer(spark, data_dir)
    segment = rel.filter_all(customer, rel.starts_with("c_mktsegment", "B")).select("c_custkey")
    return segment.hint("merge").join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("cid"), F.col("o_totalprice").alias("total"))


@query("bucketed_customer_totals", oracle="""
SELECT c_custkey AS cid, c_mktsegment AS segment, count(o_custkey) AS cnt,
       CAST(sum(CAST(trunc(o_totalprice) AS INTEGER)) AS BIGINT) AS tot
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_custkey, c_mktsegment
""")
def bucketed_customer_totals(spark, data_dir):
    """Every customer with the number and total of the orders, on the same
    layout: grouping and join both keep the buckets, without an exchange."""
    customer, orders = _by_customer(spark, data_dir)
    totals = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("cnt"),
                                             F.sum(to_type("o_totalprice", "int")).alias("tot"))
    joined = customer.hint("merge").join(totals, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(F.col("c_custkey").alias("cid"), F.col("c_mktsegment").alias("segment"),
                         F.coalesce("cnt", F.lit(0).cast("bigint")).alias("cnt"), "tot")


@query("sql_month_filter", oracle="SELECT * FROM orders WHERE month(o_orderdate) = 7")
def sql_month_filter(spark, data_dir):
    """``select *`` through SQL, then a month filter."""
    register_tables(spark, data_dir, ("orders",))
    return rel.filter_month(spark.sql("SELECT * FROM orders"), "o_orderdate", JULY)


@query("month_filter_distinct",
       oracle="SELECT DISTINCT o_custkey FROM orders WHERE month(o_orderdate) = 7")
def month_filter_distinct(spark, data_dir):
    """Distinct customers with an order in July (filter before projection, D2)."""
    return rel.distinct_in_month(load_table(spark, data_dir, "orders"), "o_orderdate", JULY,
                                 ["o_custkey"])


CUSTOMER_TOTALS_SQL = """
WITH whole AS (SELECT o_custkey AS cid, CAST(o_totalprice AS INT) AS amount FROM orders)
SELECT cid, sum(amount) AS tot, count(DISTINCT amount) AS cnt FROM whole GROUP BY cid
"""


@query("sql_sum_distinct", oracle="""
WITH whole AS (SELECT o_custkey AS cid, CAST(trunc(o_totalprice) AS INTEGER) AS amount FROM orders)
SELECT cid, CAST(sum(amount) AS BIGINT) AS tot, count(DISTINCT amount) AS cnt FROM whole GROUP BY cid
""")
def sql_sum_distinct(spark, data_dir):
    """A4: SUM and COUNT(DISTINCT) per key through SQL (Spark truncates double -> int)."""
    register_tables(spark, data_dir, ("orders",))
    return spark.sql(CUSTOMER_TOTALS_SQL)


@query("group_sum", oracle="""
SELECT o_custkey AS cid, CAST(sum(CAST(trunc(o_totalprice) AS INTEGER)) AS BIGINT) AS tot
FROM orders GROUP BY o_custkey
""")
def group_sum(spark, data_dir):
    """Typed total, then SUM per customer, DataFrame form."""
    o = load_table(spark, data_dir, "orders")
    typed = o.select(F.col("o_custkey").alias("cid"),
                     to_type("o_totalprice", "int", strict=True).alias("total"))
    return rel.group_sum(typed, "cid", "total", "tot")


_LINEITEM_NUMERIC = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax")


@query("group_avg_all", oracle="SELECT l_returnflag, l_linestatus, "
       + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in _LINEITEM_NUMERIC)
       + " FROM lineitem GROUP BY l_returnflag, l_linestatus")
def group_avg_all(spark, data_dir):
    """A3: average of every numeric column per group, rounded for cross-engine comparison."""
    li = load_table(spark, data_dir, "lineitem").drop("l_shipdate")
    out = rel.group_avg_all(li, "l_returnflag", "l_linestatus")
    return out.select("l_returnflag", "l_linestatus",
                      *[F.round(f"avg_{c}", 6).alias(f"avg_{c}") for c in _LINEITEM_NUMERIC])


@query("project_rename", oracle="""
SELECT l_orderkey AS orderkey, l_linenumber, l_quantity AS qty, l_returnflag AS flag
FROM lineitem
""")
def project_rename(spark, data_dir):
    """Projection, alias, in-place rename, drop."""
    li = load_table(spark, data_dir, "lineitem")
    out = rel.project(li, ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_tax"])
    out = rel.rename(out, {"l_quantity": "qty"})
    out = out.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "qty",
                     F.col("l_returnflag").alias("flag"), "l_tax")
    return rel.drop(out, "l_tax")


@query("binarize_label", oracle="""
SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS FLOAT) AS y FROM lineitem
""")
def binarize_label(spark, data_dir):
    """String equality cast to a 0.0/1.0 FLOAT label."""
    li = load_table(spark, data_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", rel.binarize("l_returnflag", "R").alias("y"))


@query("case_not_null", oracle="""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount / NULLIF(l_tax, 0) IS NOT NULL THEN 1 ELSE 0 END AS has_ratio
FROM lineitem
""")
def case_not_null(spark, data_dir):
    """P10 on a value that is NULL for some rows (discount / tax, NULL when tax = 0)."""
    li = load_table(spark, data_dir, "lineitem")
    ratio = F.try_divide(F.col("l_discount"), F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber", rel.not_null_flag(ratio).alias("has_ratio"))


@query("accuracy", oracle="""
SELECT count(*) FILTER (WHERE quality = toxic) AS hits, count(*) AS total,
       CAST(count(*) FILTER (WHERE quality = toxic) AS DOUBLE) / count(*) AS accuracy
FROM labels
""")
def accuracy(spark, data_dir):
    """Share of rows with y = prediction, one aggregation (no driver loop)."""
    lab = load_table(spark, data_dir, "labels")
    return metrics.accuracy(lab, "quality", "toxic")


@query("class_recall", oracle="""
SELECT 0.0::DOUBLE AS class, count(*) FILTER (WHERE quality = 0) AS support,
       count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS hits,
       CAST(count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS DOUBLE)
         / NULLIF(count(*) FILTER (WHERE quality = 0), 0) AS recall
FROM labels
UNION ALL
SELECT 1.0::DOUBLE, count(*) FILTER (WHERE quality = 1),
       count(*) FILTER (WHERE quality = 1 AND toxic = 1),
       CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS DOUBLE)
         / NULLIF(count(*) FILTER (WHERE quality = 1), 0)
FROM labels
""")
def class_recall(spark, data_dir):
    """Support, hits and recall of both classes in one pass."""
    lab = load_table(spark, data_dir, "labels")
    return metrics.class_recall(lab, "quality", "toxic")


@query("mean_stddev_pop", oracle="""
SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean,
       round(stddev_pop(value), 6) AS std
FROM events GROUP BY event_type
""")
def mean_stddev_pop(spark, data_dir):
    """Mean and population std per group (numpy ddof=0)."""
    ev = load_table(spark, data_dir, "events")
    out = metrics.mean_stddev_pop(ev, "value", "event_type")
    return out.select("event_type", "n", F.round("mean", 6).alias("mean"),
                      F.round("std", 6).alias("std"))
