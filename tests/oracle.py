"""Compare a registered query with its DuckDB oracle, the way the driver does:
column names sorted, row count, and the multiset of exact row values."""

from __future__ import annotations

import math
import sys
from collections import Counter

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from kestrel.sources.tables import TABLES, table_path  # noqa: E402


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(data_dir, t)}')")
    return con


def _norm(v):
    if isinstance(v, float):
        # repr keeps what a value hash sees: -0.0 differs from 0.0
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


# Spark type name -> DuckDB type name for the types the queries return.
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
          "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
          "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def compare(spark, con, fn, sql, data_dir):
    sdf = fn(spark, data_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duckdb={d_cols}")
        return problems
    for f in sdf.schema.fields:
        want = _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if want != d_types[f.name]:
            problems.append(f"type of {f.name}: spark {f.dataType.simpleString()} duckdb {d_types[f.name]}")
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_set = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    d_set = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duckdb={len(d_rows)}")
    if s_set != d_set:
        only_s = list((s_set - d_set).elements())[:3]
        only_d = list((d_set - s_set).elements())[:3]
        problems.append(f"values differ ({order}): spark-only {only_s} duckdb-only {only_d}")
    return problems
