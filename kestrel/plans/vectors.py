"""Array and vector queries on ``embeddings`` (FLOAT arrays widened to DOUBLE)
and on assembled ``lineitem`` features (F5-F7, A8, M1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import affine, drop_last, euclidean
from ..operators import fixed_sums
from ..operators.features import assemble
from ..operators.vectors import explode_vector, vector_mean_by_key, vector_sum_by_key
from ..session import scratch_path
from ..sources.tables import load_table
from .registry import query

# Affine map of the reference's generator: 10 + s * x, here with s = 2.
AFFINE_OFFSET = 10.0
AFFINE_SCALE = 2.0
# 64 MB of doubles.
MEANS_BROADCAST_NUMBERS = 8_000_000


@query("array_drop_last", oracle="""
SELECT vec_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos,
       CAST(unnest(l) AS DOUBLE) AS value
FROM (SELECT vec_id, embedding[1:len(embedding) - 1] AS l FROM embeddings)
""")
def array_drop_last(spark, data_dir):
    """every element but the last, one row per element."""
    emb = load_table(spark, data_dir, "embeddings")
    arr = emb.select("vec_id", drop_last("embedding").alias("v"))
    out = explode_vector(arr, "v")
    return out.withColumn("value", F.col("value").cast("double"))


@query("array_affine", oracle="""
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
       CAST(10 AS DOUBLE) + CAST(2 AS DOUBLE) * CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings
""")
def array_affine(spark, data_dir):
    """element-wise 10 + 2x."""
    emb = load_table(spark, data_dir, "embeddings")
    # FLOAT elements are widened exactly by the DOUBLE arithmetic
    arr = emb.select("vec_id", affine("embedding", AFFINE_OFFSET, AFFINE_SCALE).alias("v"))
    return explode_vector(arr, "v")


@query("euclidean_distance", oracle="""
WITH pts AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings),
means AS (SELECT label, pos, avg(v) AS m FROM pts GROUP BY label, pos)
SELECT p.vec_id, p.label, round(sqrt(sum((p.v - m.m) * (p.v - m.m))), 6) AS dist
FROM pts p JOIN means m ON p.label = m.label AND p.pos = m.pos
GROUP BY p.vec_id, p.label
""")
def euclidean_distance(spark, data_dir):
    """F6 (and A9): distance of each vector to the mean vector of its label.

    The per-label means are one aggregation. Their measured size decides the
    join back on the label: up to ``MEANS_BROADCAST_NUMBERS`` they are sent to
    the tasks and no vector is shuffled, beyond that it is a plain join.
    """
    emb = load_table(spark, data_dir, "embeddings")
    path = scratch_path(spark, "label-means")
    vector_mean_by_key(emb, "label", "embedding", out="m", count_col=None).write.parquet(path)
    means = spark.read.parquet(path)
    if (means.agg(F.sum(F.size("m"))).first()[0] or 0) <= MEANS_BROADCAST_NUMBERS:
        means = F.broadcast(means)
    return emb.join(means, "label").select(
        "vec_id", "label", F.round(euclidean("embedding", "m"), 6).alias("dist"))


@query("vector_sum_by_key", oracle="""
SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(sum(v), 6) AS value
FROM (SELECT label, generate_subscripts(embedding, 1) AS pos,
             CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
GROUP BY label, pos
""")
def vector_sum_by_key_q(spark, data_dir):
    """Element-wise sum of the vectors of each label."""
    emb = load_table(spark, data_dir, "embeddings")
    sums = vector_sum_by_key(emb, "label", "embedding", out="s")
    return explode_vector(sums.select("label", F.transform("s", lambda x: F.round(x, 6)).alias("s")),
                          "s")


FIXED_SQL = """
WITH pts AS (SELECT label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                    CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
one AS (SELECT pow(2.0, 52 - (floor(log2(max(abs(v)))) + 1)) AS unit FROM pts)
SELECT label, pos, round(CAST(sum(CAST(round_even(v * unit, 0) AS HUGEINT)) AS DOUBLE) / min(unit) {mean}, 9) AS value
FROM pts, one GROUP BY label, pos
"""


def _fixed(spark, data_dir, mean):
    emb = load_table(spark, data_dir, "embeddings")
    out = fixed_sums.vector_by_key(emb, "label", "embedding", out="s", mean=mean)
    return explode_vector(out.select("label", F.transform("s", lambda x: F.round(x, 9)).alias("s")), "s")


@query("vector_sum_fixed", oracle=FIXED_SQL.format(mean=""))
def vector_sum_fixed(spark, data_dir):
    """Element-wise sum of the vectors of each label, the same bits in any order."""
    return _fixed(spark, data_dir, mean=False)


@query("vector_mean_fixed", oracle=FIXED_SQL.format(mean="/ count(v)"))
def vector_mean_fixed(spark, data_dir):
    """Element-wise mean of the vectors of each label, the same bits in any order."""
    return _fixed(spark, data_dir, mean=True)


_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("assemble_features", oracle="""
SELECT l_orderkey, l_linenumber, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS pos,
       unnest(f) AS value
FROM (SELECT l_orderkey, l_linenumber,
             [l_quantity, l_extendedprice, l_discount, l_tax] AS f FROM lineitem)
""")
def assemble_features(spark, data_dir):
    """M1: numeric columns in the order named -> one vector, shown one row per slot."""
    li = load_table(spark, data_dir, "lineitem")
    out = assemble(li.select("l_orderkey", "l_linenumber", *_FEATURES), list(_FEATURES),
                   as_array=True)
    return explode_vector(out.select("l_orderkey", "l_linenumber", "features"), "features")
