"""Evaluation and summary aggregates.

The reference loops over ``collect()`` on the driver for accuracy and runs four
separate count jobs for recall. Both are single aggregations here: one pass,
partial counts per task, one row per task into the final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(scored: DataFrame, label_col: str = "y",
             prediction_col: str = "prediction") -> DataFrame:
    """One row: ``hits``, ``total``, ``accuracy`` (NULL on empty input)."""
    hits = F.count_if(F.col(label_col) == F.col(prediction_col))
    total = F.count(F.lit(1))
    return scored.agg(hits.alias("hits"), total.alias("total")) \
        .withColumn("accuracy", F.try_divide(F.col("hits"), F.col("total")))


def class_recall(scored: DataFrame, label_col: str = "y",
                 prediction_col: str = "prediction",
                 classes: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """Per class: ``support`` (rows of that class), ``hits`` (rows of that class
    predicted as it) and ``recall`` = hits / support, NULL when the class is
    absent (D20). Every class in ``classes`` gets a row, present or not.
    """
    y, p = F.col(label_col), F.col(prediction_col)
    aggs = []
    for i, c in enumerate(classes):
        aggs.append(F.count_if(y == F.lit(c)).alias(f"s{i}"))
        aggs.append(F.count_if((y == F.lit(c)) & (p == F.lit(c))).alias(f"h{i}"))
    wide = scored.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(c)).alias("class"), F.col(f"s{i}").alias("support"),
                              F.col(f"h{i}").alias("hits"))
                     for i, c in enumerate(classes)])
    return (wide.select(F.inline(rows))
                .withColumn("recall", F.try_divide(F.col("hits"), F.col("support"))))


def mean_stddev_pop(df: DataFrame, value_col: str, *keys: str) -> DataFrame:
    """Mean and population standard deviation (numpy ``ddof=0``) per key."""
    aggs = [F.count(value_col).alias("n"), F.avg(value_col).alias("mean"),
            F.stddev_pop(value_col).alias("std")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
