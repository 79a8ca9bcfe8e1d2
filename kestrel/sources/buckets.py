"""Tables stored bucketed by a key, for joins that are repeated.

A table written once in ``n`` buckets, sorted by its key, is read already
partitioned by it: joins and groupings on the key of tables with equally many
buckets plan without an exchange, each time they run. The one shuffle is paid when
the layout is written; rows are dealt with the hash that buckets use, so every
bucket is one file.

Files lie under the shared scratch folder; the table is known to the session's
catalog under a fresh name. A key that holds many rows makes a large bucket: choose
the key accordingly, or leave such a table unbucketed and let adaptive execution
split the skewed join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_layouts: dict[tuple[str, str, int], dict[str, str]] = {}  # (application, name, buckets) -> table names


def write_bucketed(df: DataFrame, key: str, buckets: int) -> str:
    """``df`` written in ``buckets`` buckets of ``key``; the name of the table.
    Rows with a null key are kept (they share a bucket)."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    table = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", scratch_path(df.sparkSession, table)).saveAsTable(table))
    return table


def layout(spark: SparkSession, name: str, tables: dict[str, tuple[DataFrame, str]],
           buckets: int) -> dict[str, DataFrame]:
    """``tables`` (label -> table and its key) in one bucketed layout, written at the
    first call of this application under ``name`` and only read at later ones."""
    own = (spark.sparkContext.applicationId, name, buckets)
    if own not in _layouts or not all(map(spark.catalog.tableExists, _layouts[own].values())):
        _layouts[own] = {label: write_bucketed(df, key, buckets) for label, (df, key) in tables.items()}
    return {label: spark.table(table) for label, table in _layouts[own].items()}
