"""Connected components of a link table by contraction.

Every round sends each node to its smallest neighbour, follows that once more, and
replaces the links' ends; links inside a group vanish, so the table shrinks from
round to round. Nothing is collected; tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, sized


def relabel(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``column`` replaced by its label where ``labels`` (node, label) has one."""
    names = df.columns
    new = F.coalesce("_label", column).alias(column)
    to = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return df.join(to, F.col(column) == F.col("_node"), "left").select(*[new if c == column else c for c in names])


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b). Nodes that
    are in no link, or only in links with themselves, have no row."""
    left = saved(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = saved(ends.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
        step = saved(relabel(nearest, "label", sized(nearest)), "labels")
        step = sized(step)
        labels = step if labels is None else relabel(labels, "label", step)
        left = relabel(relabel(left, "a", step), "b", step).where("a <> b")
        left = saved(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return saved(links.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0) if labels is None else labels, "labels")
