"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


BATCH_ROWS = 1_000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def keep_batches_small(spark: SparkSession) -> None:
    """From now on at most ``BATCH_ROWS`` rows go to a Python worker at once, for
    results that the caller writes. Only the session's batch size changes."""
    before = int(spark.conf.get(_BATCH_KEY))
    spark.conf.set(_BATCH_KEY, str(min(before, BATCH_ROWS) if before > 0 else BATCH_ROWS))


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, at most ``BATCH_ROWS`` rows go to a Python worker at once: a batch of
    whole texts is held several times, in the executor and in the worker."""
    before = spark.conf.get(_BATCH_KEY)
    keep_batches_small(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_KEY, before)


_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when the query ends, not when the
    driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_KEY)
        else:
            spark.conf.set(_CLEANUP_KEY, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: a lost executor never makes the work before it run again, and
    the shuffles behind the table are dropped once it is written.
    """
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession), shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_offsets(spark: SparkSession, df: DataFrame, part: str, size: str, offset: str) -> DataFrame:
    """(part, offset): sum of ``size`` over all smaller parts. One row for each
    part, so its length is the number of tasks that wrote ``df``; broadcast it."""
    totals = df.groupBy(part).agg(F.sum(size).alias("_n")).orderBy(part).collect()
    ends = itertools.accumulate(r["_n"] for r in totals)
    rows = [(r[part], end - r["_n"]) for r, end in zip(totals, ends)]
    return F.broadcast(spark.createDataFrame(rows, f"{part} int, {offset} bigint"))


def only(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; whatever else the table has is left behind."""
    return df.select(*[df[n] for n in names])


BROADCAST_ROWS = 300_000


def sized(df: DataFrame) -> DataFrame:
    """``df``, a written table of narrow rows, marked for broadcast if it has at
    most ``BROADCAST_ROWS`` rows (some 10 MB); beyond that a join shuffles it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
