"""Feature indexing, logistic regression, MLlib k-means, the Lloyd loop and the
generator, on the driver's tables.

The Lloyd loop's oracles (``lloyd_converge`` and the hash-seeded
``lloyd_restarts``) are recursive CTEs. Fitted models get inputs whose answer
SQL can state: targets that the features decide, groups far apart. Random values
are counter-based, so SQL computes the same.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import random
from ..operators import classify, cluster_ml, features, lloyd as L, metrics, report
from ..operators.ordering import hash_sample_k, sample_k as sample_rows, with_row_id
from ..operators.vectors import explode_vector
from ..session import scratch_path
from ..sources.generate import gaussian_points
from ..sources.tables import load_table
from .files import generate_then_cluster
from .registry import query

EVENTS_SPLIT = "2024-01-16"      # fit on events before, apply to events from this day on
SHIP_SPLIT = "1998-01-01"        # lineitem: train before, test from this day on


def _before(c: str, day: str):
    return F.col(c) < F.lit(day).cast("timestamp_ntz")


@query("string_index", oracle=f"""
WITH lab AS (
  SELECT event_type,
         CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS code
  FROM events WHERE ts < TIMESTAMP '{EVENTS_SPLIT}' GROUP BY event_type)
SELECT e.event_id, e.event_type,
       coalesce(l.code, CAST((SELECT count(*) FROM lab) AS DOUBLE)) AS code
FROM events e LEFT JOIN lab l USING (event_type)
WHERE e.ts >= TIMESTAMP '{EVENTS_SPLIT}'
""")
def string_index(spark, data_dir):
    """M2: codes fitted on earlier events, applied to later ones (unseen -> numLabels)."""
    ev = load_table(spark, data_dir, "events")
    train, test = ev.filter(_before("ts", EVENTS_SPLIT)), ev.filter(~_before("ts", EVENTS_SPLIT))
    model = features.fit_indexer(train, ["event_type"])
    return model.transform(test).select("event_id", "event_type",
                                        F.col("_event_type_idx").alias("code"))


def _code_cte(col: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {col},
         CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS code
  FROM lineitem WHERE l_shipdate < TIMESTAMP '{SHIP_SPLIT}' GROUP BY {col})"""


@query("string_index_multi", oracle=f"""
WITH {_code_cte('l_returnflag', 'rf')}, {_code_cte('l_linestatus', 'ls')}
SELECT li.l_orderkey, li.l_linenumber,
       coalesce(rf.code, CAST((SELECT count(*) FROM rf) AS DOUBLE)) AS l_returnflag,
       coalesce(ls.code, CAST((SELECT count(*) FROM ls) AS DOUBLE)) AS l_linestatus
FROM lineitem li LEFT JOIN rf USING (l_returnflag) LEFT JOIN ls USING (l_linestatus)
WHERE li.l_shipdate >= TIMESTAMP '{SHIP_SPLIT}'
""")
def string_index_multi(spark, data_dir):
    """M3: both flags indexed by one fitted model; each code replaces its column."""
    li = load_table(spark, data_dir, "lineitem")
    train, test = li.filter(_before("l_shipdate", SHIP_SPLIT)), li.filter(~_before("l_shipdate", SHIP_SPLIT))
    cols = ["l_returnflag", "l_linestatus"]
    out = features.index_columns(train, test, cols)
    return out.select("l_orderkey", "l_linenumber", *cols)


@query("string_index_joined", oracle=f"""
WITH {_code_cte('l_returnflag', 'rf')}, {_code_cte('l_linestatus', 'ls')}
SELECT li.l_orderkey, li.l_linenumber,
       coalesce(rf.code, CAST((SELECT count(*) FROM rf) AS DOUBLE)) AS l_returnflag,
       coalesce(ls.code, CAST((SELECT count(*) FROM ls) AS DOUBLE)) AS l_linestatus
FROM lineitem li LEFT JOIN rf USING (l_returnflag) LEFT JOIN ls USING (l_linestatus)
WHERE li.l_shipdate >= TIMESTAMP '{SHIP_SPLIT}'
""")
def string_index_joined(spark, data_dir):
    """M3 without the driver: the label table stays distributed and is joined."""
    li = load_table(spark, data_dir, "lineitem")
    train, test = li.filter(_before("l_shipdate", SHIP_SPLIT)), li.filter(~_before("l_shipdate", SHIP_SPLIT))
    cols = ["l_returnflag", "l_linestatus"]
    out = features.index_by_frequency(train, test, cols)
    return out.select("l_orderkey", "l_linenumber", *cols)


@query("string_index_many", oracle="""
WITH lab AS (
  SELECT o_custkey, CAST(row_number() OVER (ORDER BY count(*) DESC, o_custkey) - 1 AS DOUBLE) AS code
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
SELECT o.o_orderkey, coalesce(l.code, CAST((SELECT count(*) FROM lab) AS DOUBLE)) AS code
FROM orders o LEFT JOIN lab l USING (o_custkey)
""")
def string_index_many(spark, data_dir):
    """M2 on a column of many values, fitted on the orders not pending."""
    o = load_table(spark, data_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    out = features.index_by_frequency(o.where("o_orderstatus <> 'P'"), o, ["o_custkey"])
    return out.select("o_orderkey", F.col("o_custkey").alias("code"))


# -- logistic regression -------------------------------------------------------------

_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CATEGORICAL = ["l_linestatus"]


def _split_lineitem(spark, data_dir, label: str, positive: str):
    """Connection-record flow on lineitem: y = 1.0 where ``label`` is ``positive``."""
    li = classify.label_binary(load_table(spark, data_dir, "lineitem").withColumn("_label", F.col(label)),
                               "_label", positive)
    return li.filter(_before("l_shipdate", SHIP_SPLIT)), li.filter(~_before("l_shipdate", SHIP_SPLIT))


def _status_scored(spark, data_dir):
    """y = (line status is 'O'), which only the code of the categorical tells."""
    train, test = _split_lineitem(spark, data_dir, "l_linestatus", "O")
    model = classify.fit(train, _NUMERIC, _CATEGORICAL, "y",
                         max_iter=classify.MAX_ITER_CONNECTION_RECORDS)
    return classify.score(model, test, keep=["l_orderkey", "l_linenumber"])


_DECIDED = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@query("logreg_fit", oracle="""
SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'l_extendedprice', '(intercept)']) AS feature,
       unnest([1, 1, -1, 0, 0]) AS sign, TRUE AS optimal
""")
def logreg_fit(spark, data_dir):
    """M4, M6 (elastic net 0.03 / 0.8): quantity, discount and tax decide the label
    partly, beside noise; the price only repeats the quantity and keeps no weight. Per
    feature the sign of its weight, and whether the weights meet the conditions that
    hold at the minimum and nowhere else (the intercept's sign isn't reported)."""
    li = load_table(spark, data_dir, "lineitem").where(_before("l_shipdate", SHIP_SPLIT))
    noise = random.gaussian(F.expr(_ROW_ID), seed=11)
    pull = (F.col("l_quantity") - 25) / 8 + (F.col("l_discount") - 0.05) * 60 - (F.col("l_tax") - 0.04) * 60
    train = li.withColumn("y", (pull + 1.5 * noise > 0).cast("float"))
    model = classify.fit(train, _DECIDED, (), "y", max_iter=classify.MAX_ITER_CONNECTION_RECORDS)
    out = classify.optimality(model, train, _DECIDED)
    sign = F.when(F.col("feature") == "(intercept)", 0).otherwise(F.signum("weight")).cast("int")
    return out.select("feature", sign.alias("sign"), (F.col("violation") < 1e-3).alias("optimal"))


@query("logreg_score", oracle=f"""
SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'O' AS DOUBLE) AS y,
       CAST(l_linestatus = 'O' AS DOUBLE) AS prediction, TRUE AS sums_to_one
FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SHIP_SPLIT}'
""")
def logreg_score(spark, data_dir):
    """M5: prediction for the held-out rows; both probabilities add up to 1."""
    return _status_scored(spark, data_dir).select(
        "l_orderkey", "l_linenumber", F.col("y").cast("double").alias("y"), "prediction",
        (F.abs(F.get("probability", 0) + F.get("probability", 1) - 1) < 1e-9).alias("sums_to_one"))


@query("logreg_recall", oracle=f"""
WITH t AS (
  SELECT CAST(l_linestatus = 'O' AS DOUBLE) AS y FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SHIP_SPLIT}')
SELECT c.class, count(t.y) AS support, count(t.y) AS hits,
       CASE WHEN count(t.y) > 0 THEN CAST(1 AS DOUBLE) END AS recall
FROM (SELECT CAST(unnest([0, 1]) AS DOUBLE) AS class) c LEFT JOIN t ON t.y = c.class GROUP BY c.class
""")
def logreg_recall(spark, data_dir):
    """A14 on the model's predictions: support, hits, recall of both classes."""
    return metrics.class_recall(_status_scored(spark, data_dir), "y", "prediction")


@query("logreg_accuracy", oracle=f"""
SELECT count(*) AS hits, count(*) AS total, CAST(1 AS DOUBLE) AS accuracy
FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SHIP_SPLIT}'
""")
def logreg_accuracy(spark, data_dir):
    """Four-feature flow (maxIter 10) with a learnable target: y = quantity > 25; A13."""
    li = load_table(spark, data_dir, "lineitem")
    li = li.withColumn("y", (F.col("l_quantity") > 25).cast("float"))
    train, test = li.filter(_before("l_shipdate", SHIP_SPLIT)), li.filter(~_before("l_shipdate", SHIP_SPLIT))
    model = classify.fit(train, _NUMERIC, (), "y", max_iter=classify.MAX_ITER_FOUR_FEATURES)
    return metrics.accuracy(classify.score(model, test), "y", "prediction")


# -- MLlib k-means ------------------------------------------------------------------------

FLAG_SHIFT = 1000.0
_FLAG = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"


def _flag_points(spark, data_dir):
    """Lineitem rows as points, shifted far apart by return flag."""
    li = load_table(spark, data_dir, "lineitem")
    return li.withColumn("point", F.array(F.col("l_quantity") + F.expr(_FLAG) * FLAG_SHIFT, F.col("l_tax") * 100))


def _ml_kmeans(spark, data_dir):
    """(model, points, cluster of a prediction): clusters are named by the order
    of their centers' first coordinates."""
    pts = cluster_ml.with_vector(_flag_points(spark, data_dir), "point")
    model = cluster_ml.fit(pts, k=3, seed=1)
    first = [float(c[0]) for c in model.clusterCenters()]
    names = F.array(*[F.lit(sorted(first).index(x)) for x in first])
    return model, pts, lambda prediction: F.get(names, F.col(prediction))


@query("kmeans_ml", oracle=f"""
SELECT l_orderkey, l_linenumber, CAST({_FLAG} AS INTEGER) AS cluster FROM lineitem
""")
def kmeans_ml(spark, data_dir):
    """M7, M8: k = 3, seed 1, other settings default; cluster of every row."""
    model, pts, name = _ml_kmeans(spark, data_dir)
    out = cluster_ml.predict(model, pts, keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", name("prediction").alias("cluster"))


@query("kmeans_ml_centers", oracle=f"""
WITH c AS (
  SELECT CAST({_FLAG} AS INTEGER) AS cluster, avg(l_quantity + {_FLAG} * 1000.0) AS x, avg(l_tax * 100) AS y
  FROM lineitem GROUP BY l_returnflag)
SELECT cluster, 0 AS pos, round(x, 6) AS value FROM c
UNION ALL SELECT cluster, 1, round(y, 6) FROM c
""")
def kmeans_ml_centers(spark, data_dir):
    """M9: the centers, one row per (cluster, dimension)."""
    model, _, name = _ml_kmeans(spark, data_dir)
    out = explode_vector(cluster_ml.centers(model, spark), "center")
    return out.select(name("cid").alias("cluster"), "pos", F.round("value", 6).alias("value"))


@query("kmeans_ml_report", oracle=f"""
WITH p AS (
  SELECT {_FLAG} AS cluster, l_linestatus, l_quantity AS x, l_tax * 100 AS y FROM lineitem),
c AS (SELECT cluster, avg(x) AS cx, avg(y) AS cy FROM p GROUP BY cluster),
cost AS (SELECT round(sum((x - cx) * (x - cx) + (y - cy) * (y - cy))) AS cost FROM p JOIN c USING (cluster))
SELECT l_linestatus AS label, CAST(cluster AS INTEGER) AS cluster,
       round(count(*) / sum(count(*)) OVER (PARTITION BY cluster) * 100, 6) AS percentage,
       (SELECT cost FROM cost) AS cost
FROM p GROUP BY l_linestatus, cluster
""")
def kmeans_ml_report(spark, data_dir):
    """Cost beside the line-status composition of the MLlib clusters."""
    model, pts, name = _ml_kmeans(spark, data_dir)
    pct = report.cluster_label_pct(cluster_ml.predict(model, pts, keep=["l_linestatus"]), "l_linestatus")
    cost = cluster_ml.cost(model, pts, "point", "l_orderkey").first()["cost"]
    return pct.select(F.col("l_linestatus").alias("label"), name("prediction").alias("cluster"),
                      F.round("percentage", 6).alias("percentage"), F.lit(float(round(cost))).alias("cost"))


# -- Lloyd loop -----------------------------------------------------------------

def _embedding_points(spark, data_dir):
    emb = load_table(spark, data_dir, "embeddings")
    return L.prepare_points(emb, "embedding", "vec_id")[0]


def _history_df(spark, res: L.LloydResult):
    rows = [(h["pass"], float(h["metric"]), float(h["cost"]), h["moved"], h["k"])
            for h in res.history]
    return spark.createDataFrame(rows, "pass int, metric double, cost double, moved long, k int")


# The loop as a recursive CTE: the working rows carry the current ('cur') and
# previous ('prev') centroids; a step runs while no pass has been compared
# yet or some point moved, and below 100 passes.
_CONVERGE_SQL = """WITH RECURSIVE
pts AS (
  SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings),
init AS (
  SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cid
  FROM embeddings ORDER BY vec_id LIMIT 4),
loop(it, role, cid, pos, v) AS (
  SELECT 0, 'cur', i.cid, p.pos, p.v FROM init i JOIN pts p USING (vec_id)
  UNION ALL
  SELECT * FROM (
    WITH w AS (SELECT * FROM loop),
    dist AS (
      SELECT w.role, p.vec_id, w.cid, sqrt(sum((p.v - w.v) * (p.v - w.v))) AS d
      FROM pts p JOIN w ON p.pos = w.pos GROUP BY w.role, p.vec_id, w.cid),
    asg AS (
      SELECT role, vec_id, cid FROM dist
      QUALIFY row_number() OVER (PARTITION BY role, vec_id ORDER BY d, cid) = 1),
    mv AS (
      SELECT count(*) FILTER (WHERE a.cid <> b.cid) AS moved, count(b.cid) AS has_prev
      FROM asg a LEFT JOIN asg b ON a.vec_id = b.vec_id AND b.role = 'prev'
      WHERE a.role = 'cur'),
    go AS (SELECT (SELECT any_value(it) FROM w) AS it FROM mv
           WHERE (has_prev = 0 OR moved > 0) AND (SELECT any_value(it) FROM w) < 100)
    SELECT go.it + 1, 'cur', a.cid, p.pos, avg(p.v)
    FROM go, asg a JOIN pts p USING (vec_id) WHERE a.role = 'cur'
    GROUP BY go.it, a.cid, p.pos
    UNION ALL
    SELECT go.it + 1, 'prev', w.cid, w.pos, w.v FROM go, w WHERE w.role = 'cur'
  )
),
dist AS (
  SELECT l.it, l.role, p.vec_id, l.cid, sqrt(sum((p.v - l.v) * (p.v - l.v))) AS d
  FROM pts p JOIN loop l ON p.pos = l.pos GROUP BY l.it, l.role, p.vec_id, l.cid),
asg AS (
  SELECT it, role, vec_id, cid, d FROM dist
  QUALIFY row_number() OVER (PARTITION BY it, role, vec_id ORDER BY d, cid) = 1),
per AS (
  SELECT it, cid, avg(d) AS m, sum(d * d) AS sse FROM asg WHERE role = 'cur' GROUP BY it, cid)
SELECT CAST(p.it AS INTEGER) AS pass, round(sum(p.m), 6) AS metric, round(sum(p.sse), 6) AS cost,
       (SELECT CASE WHEN p.it = 0 THEN NULL ELSE count(*) FILTER (WHERE a.cid <> b.cid) END
        FROM asg a JOIN asg b ON a.vec_id = b.vec_id AND a.it = b.it
        WHERE a.it = p.it AND a.role = 'cur' AND b.role = 'prev') AS moved,
       CAST(count(*) AS INTEGER) AS k
FROM per p GROUP BY p.it ORDER BY p.it
"""


@query("lloyd_converge", oracle=_CONVERGE_SQL)
def lloyd_converge(spark, data_dir):
    """k = 4 from the lowest ids until no point moves (at most 100 passes);
    one row per pass: metric (A10), cost (M10), moved count (M16), k."""
    res = L.lloyd(_embedding_points(spark, data_dir), 4, 100, init="lowest")
    hist = _history_df(spark, res)
    return hist.select("pass", F.round("metric", 6).alias("metric"),
                       F.round("cost", 6).alias("cost"), "moved", "k")


RESTARTS, RESTART_K, RESTART_MAX_ITERATIONS = 5, 4, 20
_M = 2147483647  # Lehmer modulus of ordering.hash_rank


def _restarts_sql() -> str:
    """Five hash-seeded runs of the loop in one recursive CTE (run = seed)."""
    return f"""WITH RECURSIVE
pts AS (
  SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings),
hashed AS (
  SELECT s.run, e.vec_id,
         ((((e.vec_id % {_M}) + {_M}) % {_M}) * 48271 + ((s.run % {_M}) * 16807 + 1) % {_M}) % {_M} AS x
  FROM embeddings e, (SELECT range AS run FROM range({RESTARTS})) s),
init AS (
  SELECT run, vec_id,
         CAST(row_number() OVER (PARTITION BY run ORDER BY (xor(x, x >> 16) * 48271) % {_M}, vec_id) - 1
              AS INTEGER) AS cid
  FROM hashed
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY (xor(x, x >> 16) * 48271) % {_M}, vec_id)
          <= {RESTART_K}),
loop(run, it, role, cid, pos, v) AS (
  SELECT i.run, 0, 'cur', i.cid, p.pos, p.v FROM init i JOIN pts p USING (vec_id)
  UNION ALL
  SELECT * FROM (
    WITH w AS (SELECT * FROM loop),
    dist AS (
      SELECT w.run, w.role, p.vec_id, w.cid, sqrt(sum((p.v - w.v) * (p.v - w.v))) AS d
      FROM pts p JOIN w ON p.pos = w.pos GROUP BY w.run, w.role, p.vec_id, w.cid),
    asg AS (
      SELECT run, role, vec_id, cid FROM dist
      QUALIFY row_number() OVER (PARTITION BY run, role, vec_id ORDER BY d, cid) = 1),
    mv AS (
      SELECT a.run, count(*) FILTER (WHERE a.cid <> b.cid) AS moved, count(b.cid) AS has_prev
      FROM asg a LEFT JOIN asg b ON a.run = b.run AND a.vec_id = b.vec_id AND b.role = 'prev'
      WHERE a.role = 'cur' GROUP BY a.run),
    its AS (SELECT run, any_value(it) AS it FROM w GROUP BY run),
    go AS (
      SELECT mv.run, its.it FROM mv JOIN its USING (run)
      WHERE (mv.has_prev = 0 OR mv.moved > 0) AND its.it < {RESTART_MAX_ITERATIONS})
    SELECT go.run, go.it + 1, 'cur', a.cid, p.pos, avg(p.v)
    FROM go JOIN asg a ON a.run = go.run JOIN pts p ON p.vec_id = a.vec_id
    WHERE a.role = 'cur' GROUP BY go.run, go.it, a.cid, p.pos
    UNION ALL
    SELECT go.run, go.it + 1, 'prev', w.cid, w.pos, w.v FROM go JOIN w ON w.run = go.run
    WHERE w.role = 'cur')
),
last AS (SELECT run, max(it) AS it FROM loop GROUP BY run),
fin AS (
  SELECT l.run, l.cid, l.pos, l.v, last.it FROM loop l JOIN last ON l.run = last.run AND l.it = last.it
  WHERE l.role = 'cur'),
d AS (
  SELECT f.run, f.it, p.vec_id, f.cid, sqrt(sum((p.v - f.v) * (p.v - f.v))) AS d
  FROM pts p JOIN fin f ON p.pos = f.pos GROUP BY f.run, f.it, p.vec_id, f.cid),
a AS (
  SELECT run, it, vec_id, cid, d FROM d
  QUALIFY row_number() OVER (PARTITION BY run, vec_id ORDER BY d, cid) = 1),
per AS (SELECT run, it, cid, avg(d) AS m FROM a GROUP BY run, it, cid),
runs AS (SELECT run, any_value(it) AS it, sum(m) AS metric FROM per GROUP BY run)
SELECT CAST(run AS INTEGER) AS restart, CAST(run AS INTEGER) AS seed, round(metric, 6) AS metric,
       CAST(it AS INTEGER) AS iterations, round(avg(metric) OVER (), 6) AS mean_metric,
       round(stddev_pop(metric) OVER (), 6) AS std_metric
FROM runs
"""


@query("lloyd_restarts", oracle=_restarts_sql())
def lloyd_restarts(spark, data_dir):
    """Five restarts from hash-seeded inits (seeds 0..4, the same
    draw on any partitioning), their metric, mean and population std."""
    runs = L.restarts(_embedding_points(spark, data_dir), RESTART_K, RESTART_MAX_ITERATIONS,
                      n=RESTARTS, base_seed=0, init="hash")
    every = Window.partitionBy()  # five rows
    return runs.select("restart", "seed", F.round("metric", 6).alias("metric"), "iterations",
                       F.round(F.avg("metric").over(every), 6).alias("mean_metric"),
                       F.round(F.stddev_pop("metric").over(every), 6).alias("std_metric"))


# -- generator ----------------------------------------------------------------------

GEN_DIMS, GEN_STD, GEN_SEED, GEN_K, GEN_DRAWS = 4, 2.0, 1, 3, 24
_ROW_ID = "l_orderkey * 8 + l_linenumber"


def _bits_sql(stream: int) -> str:
    """``random.counter_bits`` of a row id r >= 0, for seed ``GEN_SEED``."""
    key, m = random.stream_key(GEN_SEED, stream), random.MODULUS
    one = f"((r % {m}) * {random.FIRST} + {key}) % {m}"
    two = f"(xor({one}, ({one}) >> 15) * {random.SECOND} + (r >> 31) % {m} + {key}) % {m}"
    return f"((xor({two}, ({two}) >> 13) * {random.FIRST} + {key}) % {m})"


def _gaussian_sql(j: int) -> str:
    u, v = (f"(({_bits_sql(s)} + 0.5::DOUBLE) / {random.MODULUS}.0::DOUBLE)" for s in (2 * j, 2 * j + 1))
    return f"sqrt(-2.0::DOUBLE * ln({u})) * cos(2 * pi() * {v})"


_LABEL_SQL = f"CAST(floor({_bits_sql(2 * GEN_DIMS)} * {GEN_K} / {random.MODULUS}.0::DOUBLE) AS INTEGER)"


def _rows_to_draw(spark, data_dir):
    return load_table(spark, data_dir, "lineitem").withColumn("r", F.expr(_ROW_ID).cast("bigint"))


@query("gen_gaussian", oracle=f"""
WITH l AS (SELECT *, CAST({_ROW_ID} AS BIGINT) AS r FROM lineitem)
SELECT r AS id, {', '.join(f'round(l_quantity + {GEN_STD} * {_gaussian_sql(j)}, 6) AS x{j}' for j in range(GEN_DIMS))},
       {_LABEL_SQL} AS label
FROM l
""")
def gen_gaussian(spark, data_dir):
    """Gaussian noise (s = 2) around every lineitem row's quantity in
    4 dims, and a uniform label 0..2."""
    out = gaussian_points(spark, None, GEN_DIMS, GEN_K, std=GEN_STD, mean=F.col("l_quantity"), seed=GEN_SEED,
                          rows=_rows_to_draw(spark, data_dir), id_col="r")
    return out.select("id", *(F.round(f"x{j}", 6).alias(f"x{j}") for j in range(GEN_DIMS)), "label")


@query("gen_then_cluster", oracle=f"""
WITH l AS (SELECT *, CAST({_ROW_ID} AS BIGINT) AS r FROM lineitem)
SELECT CAST({_FLAG} AS BIGINT) AS cluster, {_LABEL_SQL} AS label, count(*) AS n, TRUE AS converged
FROM l GROUP BY 1, 2
""")
def gen_then_cluster(spark, data_dir):
    """Noise around every lineitem row, shifted by return flag, written as
    text, read back, and clustered from random draws until no point moves; rows by
    cluster and label. Clusters are named by the order of their smallest members."""
    rows = _rows_to_draw(spark, data_dir)
    res = generate_then_cluster(spark, scratch_path(spark, "gaussian-text"), None, GEN_K, GEN_DIMS, std=GEN_STD, seed=GEN_SEED,
                                draws=GEN_DRAWS, rows=rows, id_col="r", mean=F.expr(_FLAG) * FLAG_SHIFT + F.col("l_quantity"))
    found = res.assignment(keep=["label", "_v"])

    def counted(least):
        path = scratch_path(spark, "gaussian-clusters")
        found.groupBy("cid", "label").agg(F.count(F.lit(1)).alias("n"), least.alias("least")).write.parquet(path)
        return spark.read.parquet(path)

    try:
        # a least vector needs a sort of all points; the least first number mostly tells clusters apart
        out = counted(F.min(F.col("_v")[0]))
        firsts = [r["least"] for r in out.groupBy("cid").agg(F.min("least").alias("least")).collect()]  # k rows
        if len(set(firsts)) < len(firsts):
            out = counted(F.min("_v"))
    finally:
        res.release()
    least = out.groupBy("cid").agg(F.min("least").alias("least")).select(
        F.col("cid").alias("_cid"), (F.row_number().over(Window.orderBy("least")) - 1).cast("bigint").alias("cluster"))  # k rows
    return out.join(least, F.col("cid") == F.col("_cid")).select("cluster", F.trim("label").cast("int").alias("label"), "n",
                                                                F.lit(res.converged).alias("converged"))


# -- ids and samples ---------------------------------------------------------------------------

@query("row_id", oracle="""
SELECT label, count(*) AS n, count(DISTINCT vec_id) AS ids, TRUE AS increasing FROM embeddings GROUP BY label
""")
def row_id(spark, data_dir):
    """Unique, increasing, non-consecutive id per row; counted by label.

    Within what a task reads of a file, ids grow with the rows' places there: id less
    place is one number for each such piece (``increasing``)."""
    emb = load_table(spark, data_dir, "embeddings")
    df = with_row_id(emb.select("vec_id", "label", F.col("_metadata.file_path").alias("file"),
                                F.col("_metadata.row_index").alias("place")), "p_id")
    task = F.shiftright("p_id", 33)  # fixed value: the id's bits above the row's number in its task
    pieces = F.count_distinct("file", task)
    return df.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("p_id").alias("ids"),
        (F.count_distinct("file", task, F.col("p_id") - F.col("place")) == pieces).alias("increasing"))


@query("sample_k", oracle="""
SELECT least(count(*), 4) AS n, least(count(*), 4) AS ids, least(count(*), 4) AS members FROM embeddings
""")
def sample_k(spark, data_dir):
    """L1: four rows without replacement, seeded: how many, how many different,
    how many that are rows of the table."""
    emb = load_table(spark, data_dir, "embeddings").select("vec_id", "label")
    got = sample_rows(emb, 4, seed=1).withColumn("taken", F.lit(True))
    found = got.join(emb, ["vec_id", "label"], "left_semi").agg(F.count(F.lit(1)).alias("members"))
    counts = got.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("vec_id").alias("ids"))
    return counts.select("n", "ids", found.scalar().alias("members"))


@query("sample_k_hash", oracle=f"""
SELECT vec_id, label FROM (
  SELECT vec_id, label,
         ((((vec_id % {_M}) + {_M}) % {_M}) * 48271 + ((1 % {_M}) * 16807 + 1) % {_M}) % {_M} AS x
  FROM embeddings)
ORDER BY (xor(x, x >> 16) * 48271) % {_M}, vec_id LIMIT 4
""")
def sample_k_hash(spark, data_dir):
    """L1 with the partitioning-independent sampler: four rows, seed 1."""
    emb = load_table(spark, data_dir, "embeddings").select("vec_id", "label")
    return hash_sample_k(emb, 4, seed=1, id_col="vec_id")
