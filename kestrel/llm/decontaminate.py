"""Benchmark decontamination (operator 5): prefix-filtered set join.

A window is ``width`` consecutive words of a benchmark item (a shorter item is one
window). A document holds a window only if it holds every shingle (two words) of
it, so one necessary shingle - the prefix that containment asks for - is enough to
find candidates: the rarest in the corpus, counted over all documents. A candidate
place fixes where the window starts; the length and position bounds drop those
that don't fit the document, and the rest are compared word by word over the whole
window. Words are compared by 64-bit hash. One-word windows are their own shingle.

The benchmark is indexed by Spark: distinct (window, item) pairs, the corpus counts of
their shingles and each window's rarest shingle are tables. What travels to the tasks
is a slice of that table, of at most ``max_index_bytes`` (pairs are dealt by hash, so a
window that many items hold is spread too); a larger benchmark takes several slices,
each in a pass of its own. Documents are not shuffled (with several slices, what they
found is).

Null text has no words. Null item_id: the item counts as one item and is written as
an empty string. Repeated documents each give their row; repeated item_ids count
once; an empty benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import only, saved, sized

SHINGLE = 2
MAX_INDEX_BYTES = 64 << 20
BLOCK = 1 << 17  # candidate places verified at once
SLICE_BYTES = 1 << 19  # text worked on at once


def _shingles(h: np.ndarray, width: int) -> np.ndarray:
    return h if width == 1 else T.window_hashes(h, width)


PAIRS = "size int, words binary, item string"


def _pairs(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct (window, item): a window is its number of words and their hashes, zeros
    up to ``width``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, buf, offsets in T.slices(batch.column(1), lower=True, size=SLICE_BYTES):
                words = T.Words(buf, offsets, T.LETTER_DIGIT)
                h = np.append(words.hashes(), np.zeros(width, np.uint64))
                size = np.minimum(words.counts, width)
                n = np.where(words.counts > 0, words.counts - size + 1, 0)
                owner = np.repeat(np.arange(b - a), n)
                start = np.arange(n.sum()) + np.repeat(words.first[:-1] - (np.cumsum(n) - n), n)
                for k in range(0, len(start), BLOCK):
                    at, own = start[k:k + BLOCK], owner[k:k + BLOCK]
                    rows = h[at[:, None] + np.arange(width)]
                    rows[np.arange(width) >= size[own][:, None]] = 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(size[own], pa.int32()), _binary(rows), ids.take(pa.array(a + own))], ["size", "words", "item"])

    items = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("id"), benchmark["text"])
    return items.mapInArrow(T.tidy(cut), PAIRS).distinct()


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of numbers."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * (8 * width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column, width: int) -> np.ndarray:
    """The rows of numbers back from binary values of equal length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, _, data = column.buffers()
    if not len(column):
        return np.empty((0, width), np.uint64)
    return np.frombuffer(data, np.uint64, len(column) * width, column.offset * 8 * width).reshape(-1, width)


def _places(pairs: DataFrame, width: int) -> DataFrame:
    """Every shingle of every distinct window: size, words, shingle, inner (its place)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, h = np.asarray(batch.column(0)), _matrix(batch.column(1), width)
            for q in range(1, SHINGLE + 1):
                own = np.flatnonzero(np.minimum(size, SHINGLE) == q)
                if not len(own):
                    continue
                hashes = np.append(_shingles(h[own].ravel(), q), np.zeros(q - 1, np.uint64)).reshape(-1, width)
                row, inner = np.nonzero(np.arange(width) < (size[own] - q + 1)[:, None])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own[row])), batch.column(1).take(pa.array(own[row])),
                     pa.array(hashes[row, inner].view(np.int64)), pa.array(inner, pa.int32())],
                    ["size", "words", "shingle", "inner"])

    return pairs.select("size", "words").distinct().mapInArrow(T.tidy(cut), "size int, words binary, shingle bigint, inner int")


class Marks:
    """Membership of hashes in a sorted set: a bit table, then a binary search."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.size = np.uint64((1 << max(16, int(np.ceil(np.log2(len(keys) * 8 + 1))))) - 1)
        self.table = np.zeros(int(self.size) + 1, bool)
        self.table[(keys & self.size).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in h, place in keys) of the members."""
        at = np.flatnonzero(self.table[(h & self.size).astype(np.int64)])
        k = np.searchsorted(self.keys, h[at])
        ok = self.keys[np.minimum(k, len(self.keys) - 1)] == h[at]
        return at[ok], k[ok]


class Index:
    """Windows under their rarest shingle, from one slice of the indexed pairs."""

    def __init__(self, pairs: pa.Table, width: int):
        pairs = pairs.combine_chunks()
        words = _matrix(pairs["words"], width)
        size = np.asarray(pairs["size"]).astype(np.int64)
        rows = np.ascontiguousarray(np.column_stack([size.astype(np.uint64), words]))
        _, first, window = np.unique(rows.view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel(),
                                     return_index=True, return_inverse=True)
        self.size, self.words = size[first], words[first]
        order = np.argsort(window, kind="stable")
        self._names = pairs["item"].take(pa.array(order)).to_pylist()
        self._begin = np.searchsorted(window[order], np.arange(len(first) + 1))
        shingle = np.asarray(pairs["shingle"])[first].view(np.uint64)
        inner = np.asarray(pairs["inner"])[first].astype(np.int64)
        self.by_length = {}
        for q in range(1, SHINGLE + 1):
            own = np.flatnonzero(np.minimum(self.size, SHINGLE) == q)
            if len(own):
                own = own[np.argsort(shingle[own], kind="stable")]
                keys, begin = np.unique(shingle[own], return_index=True)
                self.by_length[q] = Marks(keys), np.append(begin, len(own)), own, inner[own]

    def items(self, window: int) -> list[str]:
        return self._names[self._begin[window]:self._begin[window + 1]]

    def occurrences(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first word, window) of the windows in texts whose words start at ``first``."""
        for q, (marks, begin, window, inner) in self.by_length.items():
            place, key = marks.find(_shingles(h, q))
            n = begin[key + 1] - begin[key]
            ends = np.cumsum(n)
            a = 0
            while a < len(n):  # some places at a time, however many windows share a shingle
                b = max(a + 1, int(np.searchsorted(ends, ends[a] - n[a] + BLOCK, side="right")))
                entry = np.arange(n[a:b].sum()) + np.repeat(begin[key[a:b]] - (np.cumsum(n[a:b]) - n[a:b]), n[a:b])
                at, w = np.repeat(place[a:b], n[a:b]), window[entry]
                start = at - inner[entry]
                doc = np.searchsorted(first, at, side="right") - 1
                fits = (start >= first[doc]) & (start + self.size[w] <= first[doc + 1])
                start, w = start[fits], w[fits]
                same = np.ones(len(w), bool)
                for k in range(self.words.shape[1]):
                    inside = k < self.size[w]
                    same &= ~inside | (h[np.where(inside, start + k, 0)] == self.words[w, k])
                yield start[same], w[same]
                a = b


def _count_shingles(docs: DataFrame, places: DataFrame, max_keys: int) -> DataFrame:
    """(q, shingle, n): how often each shingle occurs in all documents. The shingles
    travel in slices of about ``max_keys``; those that never occur have no row."""
    q = F.least("size", F.lit(SHINGLE)).alias("q")
    keys = saved(places.select(q, "shingle").distinct(), "benchmark-shingles")
    parts = keys.count() // max_keys + 1
    out = None
    for k in range(parts):
        part = _counted(docs, keys.where(F.pmod(F.xxhash64("shingle"), F.lit(parts)) == k).toArrow())
        out = part if out is None else out.unionByName(part)
    return out


def _counted(docs: DataFrame, keys: pa.Table) -> DataFrame:
    length, shingle = np.asarray(keys["q"]), np.asarray(keys["shingle"]).view(np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast({int(q): np.sort(shingle[length == q]) for q in np.unique(length)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = {q: Marks(keys) for q, keys in sent.value.items()}
        sums = {q: np.zeros(len(keys), np.int64) for q, keys in sent.value.items()}
        for batch in batches:
            for _, _, buf, offsets in T.slices(batch.column(0), lower=True, size=SLICE_BYTES):
                h = T.Words(buf, offsets, T.LETTER_DIGIT).hashes()
                for q, m in marks.items():
                    sums[q] += np.bincount(m.find(_shingles(h, q))[1], minlength=len(m.keys))
        for q, m in marks.items():
            seen = np.flatnonzero(sums[q])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), q), pa.int32()), pa.array(m.keys[seen].view(np.int64)), pa.array(sums[q][seen])],
                ["q", "shingle", "n"])

    rows = only(docs, "text").mapInArrow(T.tidy(count), "q int, shingle bigint, n bigint")
    return rows.groupBy("q", "shingle").agg(F.sum("n").alias("n"))


KEY_BYTES = 32  # a shingle in a task: its hash, its count and eight to sixteen bits of marks
PAIR_BYTES = 64  # a pair besides its words: size, shingle, place and the item's id


def _indexes(docs: DataFrame, benchmark: DataFrame, width: int, max_index_bytes: int) -> Iterator[Index]:
    pairs = saved(_pairs(benchmark, width), "benchmark-windows")
    total = pairs.count()
    if not total:
        return
    places = saved(_places(pairs, width), "benchmark-places")
    counts = sized(saved(_count_shingles(docs, places, max(1, max_index_bytes // KEY_BYTES)), "benchmark-counts"))
    q = F.least("size", F.lit(SHINGLE))
    rare = F.min(F.struct(F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "shingle", "inner"))
    chosen = places.withColumn("q", q).join(counts, ["q", "shingle"], "left").groupBy("size", "words").agg(rare.alias("r"))
    indexed = saved(pairs.join(chosen, ["size", "words"]).select("size", "words", "item", "r.shingle", "r.inner"), "benchmark-index")
    parts = -(-total * (8 * width + PAIR_BYTES) // max_index_bytes)
    for k in range(parts):
        own = indexed.where(F.pmod(F.xxhash64("words", "item"), F.lit(parts)) == k).toArrow()
        if own.num_rows:
            yield Index(own, width)


FOUND = "doc_id bigint, row bigint, n_words bigint, hit array<bigint>, items array<string>"


def _find(docs: DataFrame, index: Index | None) -> DataFrame:
    """Per row: its words, the places of those that are hit, and the items."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(2), lower=True, size=SLICE_BYTES):
                words = T.Words(buf, offsets, T.LETTER_DIGIT)
                hit, items = _hits(own, words)
                places = np.flatnonzero(hit)
                owner = np.searchsorted(words.first, places, side="right") - 1
                ends = np.searchsorted(owner, np.arange(b - a + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places - words.first[owner], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(words.counts), lists,
                     pa.array([sorted(items.get(i, ())) for i in range(b - a)], pa.list_(pa.string()))],
                    ["doc_id", "row", "n_words", "hit", "items"])

    return only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint"), F.monotonically_increasing_id().alias("row"), "text").mapInArrow(T.tidy(find), FOUND)


def _hits(index: Index | None, words: T.Words) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words are hit, and the items of each text that has some."""
    total = len(words.start)
    change = np.zeros(total + 1, np.int64)
    items: dict[int, set[str]] = {}
    if index is not None and total:
        for start, w in index.occurrences(words.hashes(), words.first):
            np.add.at(change, start, 1)
            np.add.at(change, start + index.size[w], -1)
            doc = np.searchsorted(words.first, start, side="right") - 1
            for d, k in np.unique(np.stack([doc, w], axis=1), axis=0).tolist():
                items.setdefault(d, set()).update(index.items(k))
    return np.cumsum(change[:-1]) > 0, items


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10,
                  max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    items (ids of the items found)."""
    found = None
    for index in _indexes(docs, benchmark, width, max_index_bytes):
        part = _find(docs, index)
        found = part if found is None else found.unionByName(part).groupBy("row", "doc_id", "n_words").agg(
            F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    found = _find(docs, None) if found is None else found
    return found.select(
        "doc_id", "n_words", F.size("hit").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"), F.array_sort("items").alias("items"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10,
                         max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """The documents that hold no window, all their columns as they were."""
    for index in _indexes(docs, benchmark, width, max_index_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        at = docs.columns.index("text")

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for a, _, buf, offsets in T.slices(batch.column(at), lower=True, size=SLICE_BYTES):
                    words = T.Words(buf, offsets, T.LETTER_DIGIT)
                    hit, _ = _hits(sent.value, words)
                    clean[a + np.searchsorted(words.first, np.flatnonzero(hit), side="right") - 1] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(T.tidy(keep), docs.schema)
    return docs
