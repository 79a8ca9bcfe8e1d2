"""Token ids in files of directly addressable codes (operator 3).

An id is cut into 8-bit chunks, lowest first. Level 0 holds the first chunk of
every id, level 1 the second chunk of those ids that have one, and so on; a
bitmap beside each level marks the ids that go on, and a rank directory holds
the number of marks before each block of 512, so the place of an id's next chunk
is one directory entry and one short popcount away. Any id is read without
decoding its neighbours.

Layout of a segment (little endian): b"DAC1", u32 levels; for each level u64
entries, the chunk bytes, and but for the last level the bitmap (bit i of byte
i // 8, low bit first) padded to whole blocks and u32 marks before each block.

A file is one Parquet file of a Spark write, a row for each segment: part, seg,
start (ids of the part before it), the ids and lengths of its documents, and the
segment. Parts ascend with the document id, so Spark's writers give whole files
or none however often a task runs again.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import only, running_offsets

MAGIC = b"DAC1"
BLOCK = 512
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def dac_encode(ids: np.ndarray) -> bytes:
    rest = np.asarray(ids, np.uint32)
    levels = []
    while True:
        more = rest >> 8
        goes_on = more > 0
        levels.append(((rest & 255).astype(np.uint8), goes_on))
        if not goes_on.any():
            break
        rest = more[goes_on]
    out = [MAGIC, struct.pack("<I", len(levels))]
    for k, (low, goes_on) in enumerate(levels):
        out += [struct.pack("<Q", len(low)), low.tobytes()]
        if k < len(levels) - 1:
            bits = np.packbits(np.append(goes_on, np.zeros(-len(goes_on) % BLOCK, bool)), bitorder="little")
            marks = _ONES[bits].reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
            out += [bits.tobytes(), (np.cumsum(marks, dtype=np.uint32) - marks).astype("<u4").tobytes()]
    return b"".join(out)


class Dac:
    """Read access to one encoded segment."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a DAC segment")
        (count,), at = struct.unpack_from("<I", data, 4), 8
        self.levels = []
        for k in range(count):
            (n,) = struct.unpack_from("<Q", data, at)
            low = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n
            bits = marks = None
            if k < count - 1:
                blocks = -(-n // BLOCK)
                bits = np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at)
                at += len(bits)
                marks = np.frombuffer(data, "<u4", blocks, at)
                at += 4 * blocks
            self.levels.append((low, bits, marks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, k: int, i: int) -> int:
        """Marks before entry i of level k."""
        low, bits, marks = self.levels[k]
        if i == len(low) and i % BLOCK == 0:
            return len(self.levels[k + 1][0])
        block = i // BLOCK
        first = block * BLOCK // 8
        whole = int(_ONES[bits[first:i // 8]].sum())
        return int(marks[block]) + whole + (int(_ONES[bits[i // 8] & ((1 << i % 8) - 1)]) if i % 8 else 0)

    def __getitem__(self, i: int) -> int:
        value = 0
        for k, (low, bits, _) in enumerate(self.levels):
            value |= int(low[i]) << 8 * k
            if bits is None or not bits[i // 8] >> i % 8 & 1:
                break
            i = self._rank(k, i)
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids a to b, read from their own places of each level."""
        low, bits, _ = self.levels[0]
        out = low[a:b].astype(np.uint32)
        where = np.arange(b - a)
        for k in range(1, len(self.levels)):
            if a >= b:
                break
            marked = np.unpackbits(bits[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
            a, b = self._rank(k - 1, a), self._rank(k - 1, b)
            where = where[marked]
            low, bits, _ = self.levels[k]
            out[where] |= low[a:b].astype(np.uint32) << np.uint32(8 * k)
        return out


SEGMENTS = "part int, seg int, start bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, data binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every text (null: empty) with ``end_id`` after it and write the ids
    in ascending doc_id order (null first; rows with the same id in scan order)."""
    rows = only(docs, "doc_id", "text").withColumn("_scan", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "_scan").sortWithinPartitions("doc_id", "_scan")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.shared(bpe.ChunkEncoder, tokenizer)
        part, seg, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for a, b, ids, counts in encoder.encode(batch.column(1)):
                ids = np.insert(ids.astype(np.uint32), np.cumsum(counts), end_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([start]), pa.array([len(ids)]),
                     pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                     pa.array([counts + 1], pa.list_(pa.int64())), pa.array([dac_encode(ids)], pa.binary())],
                    ["part", "seg", "start", "n_ids", "doc_ids", "lengths", "data"])
                seg, start = seg + 1, start + len(ids)

    ordered.select("doc_id", "text").mapInArrow(segments, SEGMENTS).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 of its ids as little-endian u32."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    placed = files.join(running_offsets(spark, files, "part", "n_ids", "before"), "part")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, start, ids, lengths, data in zip(*(c for c in batch.columns)):
                lengths = np.array(lengths.as_py(), np.int64)
                dac = Dac(data.as_py())
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(dac.slice(b - n, b).astype("<u4")) for b, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.as_py(), pa.int64()), pa.array(ends - lengths + (before.as_py() + start.as_py())),
                     pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("before", "start", "doc_ids", "lengths", "data").mapInArrow(
        documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_ids(spark: SparkSession, path: str, first: int, count: int) -> list[int]:
    """Ids first to first + count of the whole corpus, by direct access: only the
    segments that hold them are read."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    at = files.join(running_offsets(spark, files, "part", "n_ids", "before"), "part").withColumn(
        "at", F.col("before") + F.col("start"))
    held = at.where((F.col("at") < first + count) & (F.col("at") + F.col("n_ids") > first))
    out: list[int] = []
    for r in held.orderBy("at").select("at", "data").toLocalIterator():
        dac = Dac(bytes(r["data"]))
        out += dac.slice(max(0, first - r["at"]), min(len(dac), first + count - r["at"])).tolist()
    return out
