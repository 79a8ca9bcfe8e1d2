"""Lloyd k-means queries on ``embeddings`` and the cluster composition report.

Setting for every oracle-checked key: k = 4, initial centroids = the 4
vectors with the lowest ``vec_id`` (the deterministic init), Euclidean
distance on the FLOAT components widened to DOUBLE, ties to the lowest cid.
Pass p assigns with the centroids after p updates. The DuckDB oracle unrolls
the same passes as CTEs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lloyd as L
from ..operators import report
from ..sources.tables import load_table
from .registry import query

K = 4


def _points(spark, data_dir):
    emb = load_table(spark, data_dir, "embeddings")
    p = L.prepare_points(emb, "embedding", "vec_id", keep=["label"])
    return p.points, p.dims


def _centroids_by_pass(pts, passes: int) -> list[L.Centroids]:
    """Centroids used in passes 0..passes (fewer if the loop converged first)."""
    res = L.lloyd(pts, K, max_iterations=passes, init="lowest")
    return [h["centroids"] for h in res.history]


def _assignment(pts, cents, keep=("id", "label")):
    a = L.assign(pts, cents, keep=keep)
    return a.withColumnRenamed("id", "vec_id")


def _cte(passes: int) -> str:
    """DuckDB CTEs pts, c0, a0, c1, a1, ... up to a{passes}."""
    parts = ["""pts AS (
  SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings)""",
             f"""init AS (
  SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cid
  FROM embeddings ORDER BY vec_id LIMIT {K})""",
             "c0 AS (SELECT i.cid, p.pos, p.v FROM init i JOIN pts p USING (vec_id))"]
    for i in range(passes + 1):
        parts.append(f"""d{i} AS (
  SELECT p.vec_id, c.cid, sqrt(sum((p.v - c.v) * (p.v - c.v))) AS dist
  FROM pts p JOIN c{i} c ON p.pos = c.pos GROUP BY p.vec_id, c.cid)""")
        parts.append(f"""a{i} AS (
  SELECT vec_id, cid, dist FROM d{i}
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) = 1)""")
        parts.append(f"""c{i + 1} AS (
  SELECT a.cid, p.pos, avg(p.v) AS v FROM a{i} a JOIN pts p USING (vec_id)
  GROUP BY a.cid, p.pos)""")
    return "WITH " + ",\n".join(parts) + "\n"


@query("nearest_centroid",
       oracle=_cte(0) + "SELECT vec_id, cid, round(dist, 6) AS dist FROM a0")
def nearest_centroid(spark, data_dir):
    """Nearest of the initial centroids, without a join."""
    pts, _ = _points(spark, data_dir)
    cents = L.init_centroids(pts, K, "lowest")
    a = _assignment(pts, cents, keep=("id",))
    return a.select("vec_id", "cid", F.round("dist", 6).alias("dist"))


@query("lloyd_update",
       oracle=_cte(0) + "SELECT cid, pos, round(v, 6) AS value FROM c1")
def lloyd_update(spark, data_dir):
    """M14, A9, J3/J4 removed: member means after pass 0, one aggregation."""
    pts, _ = _points(spark, data_dir)
    upd = L.update_centroids(pts, L.init_centroids(pts, K, "lowest"))
    return upd.select("cid", F.posexplode("center").alias("pos", "value")) \
              .select("cid", "pos", F.round("value", 6).alias("value"))


@query("lloyd_3pass", oracle=_cte(2) + "SELECT vec_id, cid FROM a2")
def lloyd_3pass(spark, data_dir):
    """Assignment of the third pass (max_iterations = 2)."""
    pts, _ = _points(spark, data_dir)
    cents = _centroids_by_pass(pts, 2)[-1]
    return _assignment(pts, cents, keep=("id",)).select("vec_id", "cid")


@query("lloyd_moved", oracle=_cte(2) + """
SELECT a2.vec_id, a1.cid AS prev_cid, a2.cid FROM a2 JOIN a1 USING (vec_id)
WHERE a1.cid <> a2.cid
""")
def lloyd_moved(spark, data_dir):
    """Points whose cluster changed between passes 1 and 2."""
    pts, _ = _points(spark, data_dir)
    hist = _centroids_by_pass(pts, 2)
    moved = L.moved_points(pts, hist[-1], hist[min(1, len(hist) - 1)])
    return moved.select(F.col("id").alias("vec_id"), "prev_cid", "cid")


@query("intra_cluster_distance", oracle=_cte(1) + """
SELECT round(sum(m), 6) AS metric FROM (SELECT cid, avg(dist) AS m FROM a1 GROUP BY cid)
""")
def intra_cluster_distance(spark, data_dir):
    """Sum over clusters of the mean distance, on pass 1."""
    pts, _ = _points(spark, data_dir)
    a1 = _assignment(pts, _centroids_by_pass(pts, 1)[-1])
    return L.intra_cluster_distance(a1).select(F.round("metric", 6).alias("metric"))


@query("kmeans_cost", oracle=_cte(1) + "SELECT round(sum(dist * dist), 6) AS cost FROM a1")
def kmeans_cost(spark, data_dir):
    """Sum of squared distances to the pass-1 centroids."""
    pts, _ = _points(spark, data_dir)
    a1 = _assignment(pts, _centroids_by_pass(pts, 1)[-1])
    return L.kmeans_cost(a1).select(F.round("cost", 6).alias("cost"))


def _clustered(spark, data_dir):
    pts, _ = _points(spark, data_dir)
    a1 = _assignment(pts, _centroids_by_pass(pts, 1)[-1])
    return a1.withColumnRenamed("cid", "prediction")


@query("cluster_sizes", oracle=_cte(1) + """
SELECT cid AS prediction, count(*) AS count FROM a1 GROUP BY cid
""")
def cluster_sizes(spark, data_dir):
    """A1: rows per cluster."""
    return report.cluster_sizes(_clustered(spark, data_dir))


@query("label_by_cluster", oracle=_cte(1) + """
SELECT e.label, a.cid AS prediction, count(*) AS count
FROM a1 a JOIN embeddings e USING (vec_id) GROUP BY e.label, a.cid
""")
def label_by_cluster(spark, data_dir):
    """A2: rows per (label, cluster)."""
    return report.label_by_cluster(_clustered(spark, data_dir))


@query("cluster_label_pct", oracle=_cte(1) + """
SELECT e.label, a.cid AS prediction,
       round(count(*) / sum(count(*)) OVER (PARTITION BY a.cid) * 100, 6) AS percentage
FROM a1 a JOIN embeddings e USING (vec_id) GROUP BY e.label, a.cid
""")
def cluster_label_pct(spark, data_dir):
    """Share of each label within each cluster, in percent."""
    out = report.cluster_label_pct(_clustered(spark, data_dir))
    return out.select("label", "prediction", F.round("percentage", 6).alias("percentage"))


@query("cluster_label_pct_joined", oracle=_cte(1) + """
SELECT e.label, a.cid AS prediction,
       round(count(*) / sum(count(*)) OVER (PARTITION BY a.cid) * 100, 6) AS percentage
FROM a1 a JOIN embeddings e USING (vec_id) GROUP BY e.label, a.cid
""")
def cluster_label_pct_joined(spark, data_dir):
    """The same report by joining sizes and counts on differently named keys."""
    out = report.cluster_label_pct_join(_clustered(spark, data_dir))
    return out.select("label", "prediction", F.round("percentage", 6).alias("percentage"))
