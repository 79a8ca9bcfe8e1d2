"""MLlib k-means.

Reference settings: ``KMeans().setK(3).setSeed(1)``, all else default
(``k-means||`` init, 20 iterations, tol 1e-4). ``computeCost`` is gone from
current Spark (D12); the training cost comes from the model summary, and the
cost on other rows from :func:`cost`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lloyd import Centroids, assign, prepare_points


def with_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """ARRAY<FLOAT|DOUBLE> column -> ML vector column (JVM-side, floats widened exactly)."""
    return df.withColumn(out, array_to_vector(array_col))


# --- fixed values (the reference's MLlib k-means settings) ---
DEFAULT_K = 3
DEFAULT_SEED = 1
# ---


def fit(df: DataFrame, k: int = DEFAULT_K, seed: int = DEFAULT_SEED,
        features_col: str = "features", max_iter: int = 20) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features_col, maxIter=max_iter).fit(df)


def predict(model: KMeansModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and ``prediction`` INT (M8)."""
    return model.transform(df).select(*keep, "prediction")


def centers(model: KMeansModel, spark: SparkSession) -> DataFrame:
    """(cid, center ARRAY<DOUBLE>), k rows (M9)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cid int, center array<double>")


def training_cost(model: KMeansModel) -> float:
    """Sum of squared distances of the training rows to their centers."""
    return float(model.summary.trainingCost)


def cost(model: KMeansModel, df: DataFrame, array_col: str, id_col: str) -> DataFrame:
    """One row ``cost`` for any rows, from the model's centers (M10, SQL form)."""
    pts, *_ = prepare_points(df, array_col, id_col)
    cents = Centroids.of([list(c) for c in model.clusterCenters()])
    a = assign(pts, cents)
    return a.agg(F.sum(F.col("dist") * F.col("dist")).alias("cost"))
