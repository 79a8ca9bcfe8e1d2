"""Projections, filters, joins, aggregations and distinct.

Thin on purpose: each function states one piece of reference semantics as a
DataFrame expression and leaves the physical plan to Catalyst (pushdown into
the parquet scan, partial aggregation before every shuffle, broadcast only
when the statistics of a side are under ``autoBroadcastJoinThreshold``, and
AQE re-planning with runtime sizes).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- projections (P1-P6) ----------------------------------------------------

def project(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Keep ``columns`` in order; a mapping ``{source: new_name}`` also renames."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(src).alias(dst) for src, dst in columns.items()])
    return df.select(*columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename in place, other columns untouched."""
    return df.withColumnsRenamed(dict(mapping))


def drop(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace derived columns in one projection (P5)."""
    return df.withColumns(dict(exprs))


# -- predicates (P7-P15) ------------------------------------------------------

def filter_all(df: DataFrame, *conditions: Column) -> DataFrame:
    """Conjunction of predicates (P9): one filter, pushed down as a whole."""
    cond = conditions[0]
    for c in conditions[1:]:
        cond = cond & c
    return df.filter(cond)


def binarize(c, positive, dtype: str = "float") -> Column:
    """1.0 where the value equals ``positive``, 0.0 elsewhere.

    NULL input gives NULL, as the reference's boolean cast does.
    """
    return (_col(c) == F.lit(positive)).cast(dtype)


def not_null_flag(c) -> Column:
    """1 when the value is present, else 0 (P10)."""
    return F.when(_col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def month_is(c, month: int) -> Column:
    """Date-part predicate (P13, F3); an integer month, not text (D3)."""
    return F.month(_col(c)) == F.lit(int(month))


def filter_month(df: DataFrame, date_col: str, month: int) -> DataFrame:
    return df.filter(month_is(date_col, month))


def distinct_in_month(df: DataFrame, date_col: str, month: int,
                      columns: Sequence[str]) -> DataFrame:
    """DISTINCT ``columns`` of rows in ``month``.

    The reference projects first and filters on the dropped column (D2); here
    the filter comes first, then the projection, then the distinct, so the
    filter and the pruned columns reach the scan.
    """
    return df.filter(month_is(date_col, month)).select(*columns).distinct()


def starts_with(c, prefix: str) -> Column:
    """LIKE 'prefix%' (P11); planned as a pushed-down StringStartsWith."""
    return _col(c).startswith(prefix)


# -- joins (J1, J2) -------------------------------------------------------------

def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi-join on differently named keys (J1); duplicates kept.

    No broadcast hint: Catalyst broadcasts a side only when its estimated size
    is under the threshold, and AQE switches to a broadcast at runtime when a
    filtered side turns out small; otherwise it is a sort-merge join with
    skew splitting.
    """
    return left.join(right, left[left_key] == right[right_key], "inner")


# -- aggregations (A1-A7) -------------------------------------------------------

def group_count(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key (A1, A2, A7); column ``count``."""
    return df.groupBy(*keys).count()


def group_sum(df: DataFrame, key: str, value: str, alias: str = "tot") -> DataFrame:
    """SUM per key, DataFrame form (A5, intent of D4)."""
    return df.groupBy(key).agg(F.sum(value).alias(alias))


def group_sum_count_distinct(df: DataFrame, key: str, value: str,
                             sum_alias: str = "tot",
                             distinct_alias: str = "cnt") -> DataFrame:
    """SUM and COUNT(DISTINCT) of one value per key (A4).

    Planned as partial aggregation on (key, value), a shuffle by
    (key, value), then one row per key and map task into the shuffle by key,
    so a key holding a large share of rows does not land in one task whole.
    """
    return df.groupBy(key).agg(F.sum(value).alias(sum_alias),
                               F.count_distinct(value).alias(distinct_alias))


def group_avg_all(df: DataFrame, *keys: str, prefix: str = "avg_",
                  include_keys: bool = True) -> DataFrame:
    """Average of every numeric column per key (A3), renamed ``avg_<col>``.

    Like Spark's ``groupBy(...).avg()`` without arguments, numeric grouping
    columns are averaged too (``include_keys=False`` leaves them out). Spark
    names the columns ``avg(c)``; the rename keeps them usable in SQL.
    """
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, NumericType) and (include_keys or f.name not in keys)]
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in numeric])


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Several filtered counts in one pass (A6): one row, one column per name."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])
