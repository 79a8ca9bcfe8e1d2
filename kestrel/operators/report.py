"""Cluster composition report.

The reference counts rows per cluster and per (label, cluster), joins the two
small results and divides, then averages each one-row group again (A3). Both
counts are tiny (clusters x labels rows) once aggregated; the window form
below needs only the second aggregation and a window over its output, so the
data is scanned once. The join form is kept for two-form testing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cluster_sizes(clustered: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Rows per cluster (A1): ``prediction``, ``count``."""
    return clustered.groupBy(prediction).count()


def label_by_cluster(clustered: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Rows per (label, cluster) (A2): ``label``, ``prediction``, ``count``."""
    return clustered.groupBy(label, prediction).count()


def cluster_label_pct(clustered: DataFrame, label: str = "label",
                      prediction: str = "prediction") -> DataFrame:
    """(label, prediction, percentage): share of the cluster's rows with that label.

    NULL labels form their own group, as in ``groupBy``.
    """
    counts = label_by_cluster(clustered, label, prediction)
    total = F.sum("count").over(Window.partitionBy(prediction))
    return counts.select(label, prediction, (F.col("count") / total * 100).alias("percentage"))


def cluster_label_pct_join(clustered: DataFrame, label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    """Same result in the reference's form: sizes joined back on the cluster id."""
    sizes = cluster_sizes(clustered, prediction)
    by_label = label_by_cluster(clustered, label, prediction).select(
        F.col(prediction).alias("pred"), F.col(label).alias("_label"), F.col("count").alias("counter"))
    joined = sizes.join(by_label, sizes[prediction] == by_label["pred"])
    return joined.select(F.col("_label").alias(label), sizes[prediction],
                         (F.col("counter") / F.col("count") * 100).alias("percentage"))
