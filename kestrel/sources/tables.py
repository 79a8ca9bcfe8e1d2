"""Parquet tables of a data directory, as DataFrames and as SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(data_dir, name))


def register_tables(spark: SparkSession, data_dir: str,
                    names=TABLES) -> dict[str, DataFrame]:
    """Register each table as a session temp view under its own name."""
    frames = {}
    for name in names:
        df = load_table(spark, data_dir, name)
        df.createOrReplaceTempView(name)
        frames[name] = df
    return frames
