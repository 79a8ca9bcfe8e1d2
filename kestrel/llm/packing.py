"""Packing along a space-filling curve (operator 10).

A document's vector is its token counts, hashed into ``BUCKETS`` and projected by
a fixed sign matrix onto three axes. Cells of a grid over those axes are numbered
along a Hilbert curve; documents are range-sorted by that number, so neighbours
on the curve have alike vocabularies, and the sorted ids are cut every
``length`` ids. Only the last sequence can need padding.

Ids are computed once and written to the shared scratch folder; only (row, curve
number, length) is sorted. Null text is an empty document: its end id alone.
Documents with equal curve numbers (copies) are ordered by their place in the
scan and split over tasks like any others. Repeated rows are packed each for
itself; an empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from . import text as T
from .common import only, running_offsets, saved

BUCKETS, AXES, BITS = 256, 3, 10


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Number of each cell (rows of ``cells``, entries below 2**bits) along the
    Hilbert curve, by Skilling's transpose."""
    x = np.array(cells, np.int64)
    axes = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(axes):
            high = (x[:, i] & q) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(high, q - 1, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[:, -1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip[:, None]
    out = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            out = out << 1 | x[:, i] >> b & 1
    return out


def curve_numbers(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Curve number of every document of a slice, from its ids."""
    n = len(counts)
    bucket = T.mix(np.arange(int(ids.max(initial=0)) + 1, dtype=np.uint64) + np.uint64(1)) % np.uint64(BUCKETS)
    cell = np.repeat(np.arange(n) * BUCKETS, counts) + bucket.astype(np.int64)[ids]
    vectors = np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float64)
    vectors /= np.maximum(np.sqrt((vectors ** 2).sum(axis=1, keepdims=True)), 1)
    bits = T.mix(np.arange(BUCKETS * AXES, dtype=np.uint64) + np.uint64(7 << 32)) & np.uint64(1)
    signs = np.where(bits.reshape(BUCKETS, AXES) > 0, 1.0, -1.0)
    place = np.tanh((vectors[:, :, None] * signs).sum(axis=1))
    return hilbert(np.minimum(((place + 1) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


ENCODED = "row bigint, doc_id bigint, curve bigint, n_ids bigint, ids binary"
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int) -> DataFrame:
    """Pieces of all documents: doc_id, start (its ids before the piece), length,
    ids_crc32 (ids as little-endian u32), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    rows = only(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.shared(bpe.ChunkEncoder, tokenizer)
        wide = encoder.dtype if end_id <= np.iinfo(encoder.dtype).max else np.dtype("<u4")
        for batch in batches:
            for a, b, ids, counts in encoder.encode(batch.column(2)):
                curve = curve_numbers(ids, counts)
                ids = np.insert(ids.astype(wide), np.cumsum(counts), end_id)
                counts = counts + 1
                ends = np.cumsum(counts)
                blobs = [ids[e - n:e].tobytes() for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(curve),
                     pa.array(counts), pa.array(blobs, pa.binary())], ["row", "doc_id", "curve", "n_ids", "ids"])

    encoded = saved(rows.mapInArrow(T.tidy(encode), ENCODED), "packing-ids")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), batch.column(0), batch.column(1), pa.array(ends - n)],
                ["part", "row", "n_ids", "inner"])
            at = int(ends[-1]) if len(n) else at

    order = encoded.select("row", "n_ids", "curve").repartitionByRange("curve", "row").sortWithinPartitions("curve", "row")
    placed = saved(order.select("row", "n_ids").mapInArrow(place, "part int, row bigint, n_ids bigint, inner bigint"),
                   "packing-places")
    starts = placed.join(running_offsets(spark, placed, "part", "n_ids", "before"), "part").select(
        "row", (F.col("before") + F.col("inner")).alias("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc, at, n, blob in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(blob, np.dtype(f"<u{len(blob) // n}")).astype("<u4")
                a = 0
                while a < n:
                    b = min(n, a + length - (at + a) % length)
                    for column, value in zip(out, (doc, a, b - a, zlib.crc32(ids[a:b]), n, (at + a) // length,
                                                   (at + a) % length)):
                        column.append(value)
                    a = b
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return encoded.select("row", "doc_id", "n_ids", "ids").join(starts, "row").select(
        "doc_id", "at", "n_ids", "ids").mapInArrow(T.tidy(cut), PIECES)
