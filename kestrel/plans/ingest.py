"""Ingestion queries: delimited text, CSV, typed casts, whitespace, row index.

The reference reads hand-made text files (people and orders as delimited
text, headerless CSV). Here the text is first *derived from the driver's tables* by
a distributed write into the shared scratch folder, then read back with the
operators under test, so the work grows with the tables and the oracle can
state the expected rows directly in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import format_us_date, parse_us_date, text_to_type, to_date
from ..functions.strings import strip_ws
from ..operators.ordering import with_row_index, with_scan_index
from ..session import scratch_path
from ..sources.csv import read_csv, write_csv
from ..sources.generate import range_source
from ..sources.tables import load_table
from ..sources.text import read_delimited
from .registry import query


def _order_lines(spark, data_dir) -> str:
    """Write orders-style text lines: cid,total,priority[,status].

    Orders with status 'P' carry one extra trailing field, so the arity
    filter has lines to drop.
    """
    o = load_table(spark, data_dir, "orders")
    line = F.concat_ws(",", F.col("o_custkey").cast("string"),
                       F.col("o_totalprice").cast("int").cast("string"),
                       F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("\t")))
    line = F.when(F.col("o_orderstatus") == "P", F.concat(line, F.lit(",P"))).otherwise(line)
    path = scratch_path(spark, "order-lines")
    o.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


@query("text_split_scan", oracle="""
SELECT CAST(o_custkey AS DOUBLE) AS cid, CAST(trunc(o_totalprice) AS INTEGER) AS total
FROM orders
""")
def text_split_scan(spark, data_dir):
    """Text -> fields -> first two, typed (cid DOUBLE, total INT)."""
    path = _order_lines(spark, data_dir)
    return read_delimited(spark, path, ["cid", "total"], ["double", "int"])


@query("text_arity_filter", oracle="""
SELECT CAST(o_custkey AS DOUBLE) AS cid, CAST(trunc(o_totalprice) AS INTEGER) AS total,
       o_orderpriority AS priority
FROM orders WHERE o_orderstatus <> 'P'
""")
def text_arity_filter(spark, data_dir):
    """Keep lines with exactly three fields; strip the padded text field."""
    path = _order_lines(spark, data_dir)
    return read_delimited(spark, path, ["cid", "total", "priority"], ["double", "int", None],
                          arity=3, strip=["priority"])


_CSV_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, "
               "o_orderdate DATE, o_orderpriority STRING")


@query("csv_roundtrip", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority
FROM orders
""")
def csv_roundtrip(spark, data_dir):
    """S11 then S1: distributed CSV write, headerless typed read with a fixed schema."""
    o = load_table(spark, data_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    write_csv(o.select("o_orderkey", "o_custkey", "o_totalprice",
                       F.col("o_orderdate").cast("date").alias("o_orderdate"),
                       "o_orderpriority"), path)
    return read_csv(spark, path, _CSV_SCHEMA, mode="FAILFAST")


@query("typed_cast", oracle="""
SELECT o_orderkey,
       TRY_CAST(CAST(o_custkey AS VARCHAR) AS DOUBLE) AS cid,
       TRY_CAST(CAST(CAST(trunc(o_totalprice) AS INTEGER) AS VARCHAR) AS INTEGER) AS total,
       TRY_CAST(o_orderpriority AS INTEGER) AS bad_int
FROM orders
""")
def typed_cast(spark, data_dir):
    """Text -> DOUBLE / INT, tolerant (bad text -> NULL instead of a failed job)."""
    o = load_table(spark, data_dir, "orders")
    text = o.select("o_orderkey", F.col("o_custkey").cast("string").alias("cid"),
                    F.col("o_totalprice").cast("int").cast("string").alias("total"),
                    F.col("o_orderpriority").alias("bad_int"))
    return text.select("o_orderkey", text_to_type("cid", "double").alias("cid"),
                       text_to_type("total", "int").alias("total"),
                       text_to_type("bad_int", "int").alias("bad_int"))


@query("typed_cast_date", oracle="""
SELECT o_orderkey, TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS start_date,
       TRY_CAST(o_orderpriority AS DATE) AS bad_date
FROM orders
""")
def typed_cast_date(spark, data_dir):
    """ISO text -> DATE, tolerant."""
    o = load_table(spark, data_dir, "orders")
    text = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
                    F.col("o_orderpriority").alias("bad"))
    return text.select("o_orderkey", to_date("d").alias("start_date"),
                       to_date("bad").alias("bad_date"))


@query("parse_us_date", oracle="""
SELECT o_orderkey,
       CAST(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y') AS DATE) AS start_date,
       CAST(try_strptime(strftime(o_orderdate, '%Y-%m-%d'), '%m/%d/%Y') AS DATE) AS iso_as_us
FROM orders
""")
def parse_us_date_q(spark, data_dir):
    """U1 (D5): 'MM/dd/yyyy' text -> DATE natively; other shapes -> NULL."""
    o = load_table(spark, data_dir, "orders")
    text = o.select("o_orderkey", format_us_date("o_orderdate").alias("us"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"))
    return text.select("o_orderkey", parse_us_date("us").alias("start_date"),
                       parse_us_date("iso").alias("iso_as_us"))


@query("strip_text", oracle="""
SELECT c_custkey,
       trim(CASE WHEN c_mktsegment = 'BUILDING' THEN chr(9) || '  ' || c_name || ' ' || chr(9)
                 ELSE '   ' || c_name || chr(9) || chr(9) END, ' ' || chr(9)) AS name
FROM customer
""")
def strip_text(spark, data_dir):
    """``str.strip()`` semantics on text padded with spaces and tabs."""
    c = load_table(spark, data_dir, "customer")
    padded = F.when(F.col("c_mktsegment") == "BUILDING",
                    F.concat(F.lit("\t  "), "c_name", F.lit(" \t"))) \
              .otherwise(F.concat(F.lit("   "), "c_name", F.lit("\t\t")))
    return c.select("c_custkey", strip_ws(padded).alias("name"))


@query("range_source", oracle="""
SELECT r.id FROM (SELECT range AS id FROM range((SELECT max(o_orderkey) + 1 FROM orders))) r
ANTI JOIN orders o ON o.o_orderkey = r.id
""")
def range_source_q(spark, data_dir):
    """Of the ids 0 .. largest order key, those that no order has."""
    o = load_table(spark, data_dir, "orders").select("o_orderkey")
    n = (o.agg(F.max("o_orderkey")).first()[0] or -1) + 1
    return range_source(spark, n).join(o, F.col("id") == F.col("o_orderkey"), "left_anti")


@query("scan_index", oracle="""
SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS row_index FROM embeddings
""")
def scan_index(spark, data_dir):
    """W3 in scan order, on rows written in the order of their key."""
    path = scratch_path(spark, "ordered")
    emb = load_table(spark, data_dir, "embeddings").select("vec_id", "label")
    emb.repartitionByRange("vec_id").sortWithinPartitions("vec_id").write.option("maxRecordsPerFile", 100_000).parquet(path)
    return with_scan_index(spark.read.parquet(path))


@query("row_index", oracle="""
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index
FROM orders
""")
def row_index(spark, data_dir):
    """Consecutive 0-based index in key order without a single-task window."""
    o = load_table(spark, data_dir, "orders").select("o_orderkey", "o_custkey")
    return with_row_index(o, "o_orderkey")
