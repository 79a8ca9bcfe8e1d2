"""Sums that don't depend on the order of the rows.

Adding doubles rounds at every step, so the last bits of a sum follow the order in
which rows and tasks are merged: a retried task or another partitioning may change
them. Here a number becomes a whole number first, ``x * 2**bits`` rounded to the
nearest (ties to even), split into an upper and a lower half. Sums of longs are exact
and commute, and combine map-side like any sum; the result is rounded once, when the
total becomes a double again. The same rows give the same bits, however they lie.

``bits`` is the same for all rows. Taken from the largest magnitude (a maximum, which
commutes too), it leaves at most 52 bits to a number: an absolute precision of
``2**-53`` of the largest. A sum holds for up to 2**36 rows a key; beyond that Spark
raises an overflow, it never wraps.

Nulls are left out of sums and counts, as SQL does; NaN and infinities raise
``ValueError`` when ``bits`` is taken from the data. No rows: no row for the key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HALF = 26  # bits of the lower half
SPAN = 2 * HALF


def scale_bits(df: DataFrame, magnitude: Column) -> int:
    """``bits`` at which the largest ``magnitude`` (not negative) takes SPAN bits."""
    top = df.agg(F.max(magnitude.cast("double"))).first()[0]
    if not top:
        return 0
    if not math.isfinite(top):
        raise ValueError("numbers to add must be finite")
    return SPAN - math.frexp(top)[1]


def _scaled(x: Column, bits: int) -> Column:
    """x * 2**bits, in two steps, as 2**bits alone may be no double."""
    half = bits // 2
    return x * F.lit(2.0 ** half) * F.lit(2.0 ** (bits - half))


def fixed_sum(x: Column, bits: int) -> Column:
    """Sum of a numeric column (an aggregate), rounded once."""
    whole = F.rint(_scaled(x.cast("double"), bits)).cast("bigint")
    upper = F.sum(F.shiftright(whole, HALF))
    lower = F.sum(whole.bitwiseAND(F.lit((1 << HALF) - 1).cast("bigint")))
    total = upper.cast("decimal(20,0)") * F.lit(1 << HALF).cast("decimal(9,0)") + lower.cast("decimal(20,0)")
    return _scaled(total.cast("double"), -bits)


def fixed_mean(x: Column, bits: int) -> Column:
    return fixed_sum(x, bits) / F.count(x)


def vector_by_key(df: DataFrame, key: str, array_col: str, out: str = "sum",
                  mean: bool = False, bits: int | None = None) -> DataFrame:
    """Element-wise sum (A8) or mean (A9, M14) of the vectors of each key.

    One partial row for each (key, place) and task reaches the shuffle, so a key
    with a third of all vectors costs no more than another; what is gathered for a
    key is one vector.
    """
    if bits is None:
        bits = scale_bits(df, F.array_max(F.transform(array_col, lambda x: F.abs(x.cast("double")))))
    agg = fixed_mean if mean else fixed_sum
    places = df.select(key, F.posexplode(array_col).alias("_pos", "_x"))
    per = places.groupBy(key, "_pos").agg(agg(F.col("_x"), bits).alias("_v"))
    row = F.array_sort(F.collect_list(F.struct("_pos", "_v")))
    return per.groupBy(key).agg(F.transform(row, lambda r: r["_v"]).alias(out))


def intra_cluster_distance(assignment: DataFrame, cid_col: str = "cid",
                           dist_col: str = "dist", bits: int | None = None) -> DataFrame:
    """One row ``metric`` = sum over clusters of the mean distance (A10); the k
    means are added in the order of their clusters."""
    if bits is None:
        bits = scale_bits(assignment, F.abs(dist_col))
    per = assignment.groupBy(cid_col).agg(fixed_mean(F.col(dist_col), bits).alias("_m"))
    means = F.array_sort(F.collect_list(F.struct(cid_col, "_m")))  # k entries
    return per.agg(F.aggregate(means, F.lit(0.0), lambda s, r: s + r["_m"]).alias("metric"))
