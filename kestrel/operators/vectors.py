"""Dense vectors stored as ARRAY<DOUBLE|FLOAT> columns.

Element-wise sums and means per key go through MLlib's ``Summarizer``: one
aggregate with map-side partial sums whatever the width, so vectors of 1,536
elements plan like those of 4.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_sum_by_key(df: DataFrame, key: str, array_col: str, out: str = "sum") -> DataFrame:
    """Element-wise sum of the vectors of each key (A8, ``reduceByKey(computeSum)``)."""
    return df.groupBy(key).agg(vector_to_array(Summarizer.sum(array_to_vector(array_col))).alias(out))


def vector_mean_by_key(df: DataFrame, key: str, array_col: str, out: str = "mean",
                       count_col: str | None = "n") -> DataFrame:
    """Element-wise mean per key (A9, ``computeMean(sum, n)``)."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(array_col))).alias(out)
    n = [F.count(F.lit(1)).alias(count_col)] if count_col else []
    return df.groupBy(key).agg(mean, *n)


def explode_vector(df: DataFrame, array_col: str, pos: str = "pos",
                   value: str = "value") -> DataFrame:
    """One row per element: other columns, ``pos`` (0-based INT), ``value``."""
    others = [c for c in df.columns if c != array_col]
    return df.select(*others, F.posexplode(array_col).alias(pos, value))
