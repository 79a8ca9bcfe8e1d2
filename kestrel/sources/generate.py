"""Generated sources: integer range (S8) and Gaussian points.

The reference builds points on RDDs with an unseeded ``random.randint`` label
inside a lazy map, so each action may see other labels (D18), and it couples
the partition count with the label range and k (D19). Here every value is a
function of the seed, the row's id and the column (``functions.random``), the same
on any partitioning; n, dims, k, partitions, std and seed are separate parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.random import gaussian, uniform_int

# --- fixed values (the reference's generator: 10 + s * N(0, 1), seed 1) ---
MEAN = 10.0
SEED = 1
# ---


def range_source(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Rows ``id`` = 0 .. n-1."""
    return spark.range(0, n, 1, partitions)


def gaussian_points(spark: SparkSession, n: int | None, dims: int = 4, k: int = 3,
                    partitions: int | None = None, std: float = 1.0,
                    mean: float | Column = MEAN, seed: int = SEED,
                    as_array: bool = False, rows: DataFrame | None = None,
                    id_col: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """``n`` rows of ``dims`` values ``mean + std * N(0, 1)`` and a label in [0, k-1].

    Columns: ``id``, ``x0 .. x{dims-1}`` (or one ``features`` array when
    ``as_array``), ``label`` INT drawn uniformly with both ends included.
    With ``rows`` one point is drawn for each of its rows instead (``n`` and
    ``partitions`` are not used): ``id_col`` is the id, ``mean`` may be a column of
    it, and the columns ``keep`` stay. A row with a null id gets null values.
    """
    if rows is None and (n is None or n < 0) or dims < 1 or k < 1:
        raise ValueError("need n >= 0, dims >= 1, k >= 1")
    base = spark.range(0, n, 1, partitions) if rows is None else rows
    own = "id" if rows is None else id_col
    middle = mean if isinstance(mean, Column) else F.lit(float(mean))
    xs = [(middle + F.lit(float(std)) * gaussian(own, seed, j)).alias(f"x{j}") for j in range(dims)]
    label = uniform_int(own, k, seed, 2 * dims).alias("label")
    points = [F.array(*xs).alias("features")] if as_array else xs
    return base.select(F.col(own).alias("id"), *keep, *points, label)
