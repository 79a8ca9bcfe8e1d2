"""Row ids, consecutive row index and sampling."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row position in its low 33 bits


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique, increasing, non-consecutive id (W2); depends on partitioning."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_row_index(df: DataFrame, order_by, name: str = "row_index",
                   partitions: int | None = None,
                   rows_per_partition: int = 5_000_000) -> DataFrame:
    """Consecutive 0-based index in ``order_by`` order (W3, ``zipWithIndex``).

    The number of tasks follows the row count (``rows_per_partition``) unless
    ``partitions`` is given.

    A global ``row_number()`` would pull every row into one task. Instead:

    1. range-partition on the order key and sort inside each partition;
    2. count rows per partition (one small row per partition);
    3. turn the counts into start offsets with a window over those few rows;
    4. index = offset of the partition + position inside it, the position
       read from ``monotonically_increasing_id``'s low bits.

    The range bounds come from a sample seeded by the RDD id, so two
    evaluations of the range exchange may cut differently. The partitioned,
    numbered rows are therefore checkpointed once (reliable checkpoint in the
    shared ``spark.checkpoint.dir``: it also cuts the lineage and survives
    lost executors), and counts and rows are both read from that copy.
    The offsets table has one row per partition, a size fixed by
    ``partitions``, and is broadcast.
    Rows with equal keys get consecutive indexes in an unspecified order;
    that freedom is used against skew: a row id is appended to the range key,
    so one key value holding a large share of the rows is cut across several
    partitions instead of landing in one task.
    """
    from ..session import checkpoint_dir

    keys = list(order_by) if isinstance(order_by, (list, tuple)) else [order_by]
    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                          -(-df.count() // rows_per_partition))
    checkpoint_dir(df.sparkSession)
    tie = F.monotonically_increasing_id().alias("_tie")
    ranged = (df.select("*", tie)
                .repartitionByRange(int(n), *keys, "_tie")
                .sortWithinPartitions(*keys, "_tie")
                .drop("_tie")
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)))
                .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + F.col("_pos"))
                  .drop("_pid", "_pos", "_off"))


FILES_BROADCAST = 200_000  # rows of some 100 bytes


def with_scan_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Consecutive 0-based index in scan order (W3): by file path, then by place in the
    file, without moving a row.

    ``df`` is a scan of files (or narrow steps over one that keep all rows and its
    hidden ``_metadata`` column). Where the format numbers a file's rows (Parquet), the
    index is that number behind the rows of all files before, so it doesn't depend on how
    the scan is cut into tasks or whether a task runs again. Else a file's splits stand in
    the order of their first bytes, and a row's place in its split comes from the scan;
    both passes must then cut the files alike.

    The directory has one row for each file (or split): a count from a pass that reads no
    column, and its running sum. It is broadcast up to ``FILES_BROADCAST`` rows; beyond
    that a join by file shuffles the rows, with hot files left to AQE.
    """
    path = F.col("_metadata.file_path")
    try:
        tagged = df.select("*", path.alias("_file"), F.lit(0).cast("bigint").alias("_from"), F.col("_metadata.row_index").alias("_at"))
        in_file = True
    except AnalysisException:
        tagged = df.select("*", path.alias("_file"), F.col("_metadata.file_block_start").alias("_from"),
                           F.monotonically_increasing_id().alias("_at"))
        in_file = False
    counts = tagged.groupBy("_file", "_from").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_least"))
    before = Window.orderBy("_file", "_from").rowsBetween(Window.unboundedPreceding, -1)  # a row per file or split
    least = F.lit(0).cast("bigint") if in_file else F.col("_least")
    directory = counts.select("_file", "_from", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - least).alias("_before"))
    if counts.limit(FILES_BROADCAST + 1).count() <= FILES_BROADCAST:
        directory = F.broadcast(directory)
    return tagged.join(directory, ["_file", "_from"]).withColumn(name, F.col("_before") + F.col("_at")).drop(
        "_file", "_from", "_at", "_before")


def sample_k(df: DataFrame, k: int, seed: int) -> DataFrame:
    """k rows without replacement (L1, ``takeSample(False, k)``) with a seed.

    Ordering by a seeded random key and taking k is a TakeOrderedAndProject:
    each task keeps its own k best rows, so only k rows per task move.
    """
    return df.orderBy(F.rand(seed)).limit(k)


def lowest_k(df: DataFrame, k: int, order_by: str) -> DataFrame:
    """The k rows with the lowest key: the deterministic init of the k-means."""
    return df.orderBy(order_by).limit(k)


# Lehmer generator constants (multiplier 48271, modulus 2^31 - 1): products
# stay below 2^47, so BIGINT arithmetic is exact in any SQL engine.
_LEHMER_A, _LEHMER_M = 48271, 2147483647


def hash_rank(id_col: str, seed: int) -> Column:
    """A seeded pseudo-random BIGINT per id, computed from the id alone.

    Two Lehmer steps over (id mod M) with an xor-shift between them, mixed
    with the seed; exact BIGINT arithmetic, so any SQL engine computes the
    same value. Unlike ``rand``,
    the value does not depend on how the rows are partitioned, so a sample
    drawn with it is the same on any cluster and after any retry.
    """
    m = F.lit(_LEHMER_M).cast("bigint")
    offset = F.lit(((seed % _LEHMER_M) * 16807 + 1) % _LEHMER_M).cast("bigint")
    x = F.pmod(F.col(id_col).cast("bigint"), m)
    x = F.pmod(x * _LEHMER_A + offset, m)
    x = x.bitwiseXOR(F.shiftright(x, 16))  # breaks the linearity of two Lehmer steps
    return F.pmod(x * _LEHMER_A, m)


def hash_sample_k(df: DataFrame, k: int, seed: int, id_col: str = "id") -> DataFrame:
    """k rows without replacement, chosen by :func:`hash_rank` (ties by id).

    A TakeOrderedAndProject like :func:`sample_k`, but reproducible across
    partitionings.
    """
    return df.orderBy(hash_rank(id_col, seed), F.col(id_col)).limit(k)


def hash_sample_many(df: DataFrame, k: int, seeds: Sequence[int], id_col: str, value_col: str) -> DataFrame:
    """(seed, place, value): for each seed the ``k`` rows of :func:`hash_sample_k`, in one
    pass. Every task keeps its k least rows a seed, and those are merged: bottom-k is a
    mergeable aggregate. Rows without an id aren't drawn."""
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(value_col).alias("value"))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = dict.fromkeys(seeds)
        worst = dict.fromkeys(seeds, _LEHMER_M)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for seed in seeds:
                x = (ids % _LEHMER_M * _LEHMER_A + ((seed % _LEHMER_M) * 16807 + 1) % _LEHMER_M) % _LEHMER_M
                rank = (x ^ (x >> 16)) * _LEHMER_A % _LEHMER_M
                # what is beyond the k rows held so far can't be drawn
                at = np.flatnonzero(rank <= worst[seed])
                if not len(at):
                    continue
                at = at[np.lexsort((ids[at], rank[at]))[:k]]
                own = pa.table({"rank": rank[at], "id": ids[at], "value": batch.column(1).take(pa.array(at))})
                both = own if held[seed] is None else pa.concat_tables([held[seed], own])
                held[seed] = both.take(np.lexsort((both["id"].to_numpy(), both["rank"].to_numpy()))[:k])
                if len(held[seed]) == k:
                    worst[seed] = held[seed]["rank"][k - 1].as_py()
        for seed, own in held.items():
            if own is not None:
                own = own.combine_chunks()
                yield pa.RecordBatch.from_arrays([pa.array([seed] * len(own), pa.int64()), *(c.combine_chunks() for c in own.columns)],
                                                 ["seed", "rank", "id", "value"])

    kind = rows.schema["value"].dataType.simpleString()
    found = rows.mapInArrow(least, f"seed bigint, rank bigint, id bigint, value {kind}")
    place = F.row_number().over(Window.partitionBy("seed").orderBy("rank", "id"))  # k rows a task and seed
    return found.withColumn("place", place).where(F.col("place") <= k).select("seed", "place", "value")
