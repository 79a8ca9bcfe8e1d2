"""Exact n-gram Jaccard join (operator 6): universe-partition pigeonhole.

A document is its set of word shingles. If two sets have Jaccard similarity of at
least ``percent``, they differ in at most H = (100 - percent) (|x| + |y|) /
(100 + percent) shingles. The universe of shingles is hashed into segments, their
number set by the band of the smaller set's size; each differing shingle spoils
one segment. A set is indexed by the contents of its segments in a common order
until the allotted units pass H: a content counts one unit (some segment must be
equal), or two where the segment's one-deletion neighbourhood is indexed too (it
may differ by one shingle). Two sets that share no entry differ in at least as
many shingles as the shorter scan has units, hence in more than H, so no link is
lost. Empty segments are passed over and count nothing.

Allocation by cost: a first pass over all documents counts in how many sets each
segment is filled. Segments with far more sets than their band's others hold a
shingle that many documents share; they come last in the order, and while it is
cheaper than checking what they would pair up, the lightest segments get the
second unit in their place.

Equal sets are one class. Within an entry's bucket small groups give all pairs;
a large one is tied to its smallest member. Where a large bucket still spans more
than one component afterwards, its entry is common: the documents in such buckets
are indexed again with common entries last in the order (any order of the entries
that all sets share keeps the argument above), as long as that thins them out.
What then still spans components - sets that are common entries nearly throughout
- is compared block by block. Such sets meet again and again in buckets with much the
same members, so buckets are first merged where that costs no more comparing. The
members outside a bucket's largest component are compared with those of the size ranges
they may link with. Of the links a task finds there, only those
leave it that join what its others don't. All pairs are verified on the whole
shingle sets. Shingles are compared by 64-bit hash.

Nothing is capped. Documents without words, or without text, link with nothing.
Rows with the same doc_id are one node; each row still reports its own set. A row
without doc_id reports its set and no component. An empty table gives an empty
result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import only, saved, sized
from .components import components, relabel

_U = np.uint64
WIDTH = 5
PERCENT = 75
ORDERED_FROM = 16      # sets below this size: every shingle is a segment of its own
FEW_SEGMENTS = 1 << 14  # segments of the bands of small sets
STATS_BLOCK = 256
SMALL_BUCKET = 8       # buckets up to this size give all their pairs at once
CHECK_COST = 50        # a pair's verification, in index entries
THINNED = 0.5          # index again while common buckets shrink to this share
MERGED = 0.75          # merge residual buckets while their rows shrink to this share
BLOCK_MEMBERS = 1000   # members of a bucket compared in one task with as many others
SIZE_STEP = 4 / 3      # from the smallest to the largest set of a size range
BLOCK_VALUES = 1 << 19  # shingles of these members together, but for a single set
CELL_VALUES = 1 << 17  # members or entries of a bucket in one row
SLICE_BYTES = 1 << 19   # text worked on at once: some twenty numbers are held for a word
PART_ENTRIES = 2_000_000
SEND_ENTRIES = 1_000_000


# ---- sets -----------------------------------------------------------------

class Sets:
    """Distinct shingles of a slice of texts: flat values, counts and owners."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, width: int):
        words = T.Words(buf, offsets, T.NON_SPACE)
        h = words.hashes()
        g = T.window_hashes(h, width)
        parts = []
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if b - a >= width:
                parts.append(np.unique(g[a:b - width + 1]))
            else:
                parts.append(T.window_hashes(h[a:b], b - a) if b > a else g[:0])
        self.size = np.array([len(p) for p in parts], np.int64)
        self.values = np.concatenate(parts) if parts else g[:0]
        self.ends = np.cumsum(self.size)

    def prints(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit sums over each set, which together stand for its content."""
        out = []
        for salt in (0x51ED270B, 0x2545F491):
            sums = np.concatenate([[_U(0)], np.cumsum(T.mix(self.values ^ _U(salt)), dtype=_U)])
            out.append(sums[self.ends] - sums[self.ends - self.size])
        return out[0], out[1]

    def outlines(self) -> list[bytes | None]:
        """Counts of each set's shingles by the low bits of a hash, one byte each:
        ``outline_groups`` of them. Two sets differ in at least as many shingles as
        their counts differ by. None if a count doesn't fit (then nothing is known)."""
        groups = outline_groups(self.size)
        ends = np.cumsum(groups)
        owner = np.repeat(np.arange(len(groups)), self.size)
        low = T.mix(self.values ^ _U(0x8CB92BA72F3D8DD7)).astype(np.int64) & (groups[owner] - 1)
        counts = np.bincount((ends - groups)[owner] + low, minlength=int(groups.sum()))
        small = counts.astype(np.uint8)
        return [small[e - g:e].tobytes() if counts[e - g:e].max(initial=0) < 256 else None
                for e, g in zip(ends.tolist(), groups.tolist())]

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, place in ``which``) of the sets at the given places."""
        n = self.size[which]
        at = np.arange(n.sum()) + np.repeat(self.ends[which] - n - (np.cumsum(n) - n), n)
        return self.values[at], np.repeat(np.arange(len(which)), n)


def outline_groups(size: np.ndarray) -> np.ndarray:
    """Groups of a set's outline: 64, or the power of two within size / 2 to size."""
    return np.maximum(64, 1 << np.maximum(np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1, 0)).astype(np.int64)


def differences(x: bytes, y: bytes) -> int:
    """At least so many shingles are in only one of the sets with these outlines."""
    a, b = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    groups = min(len(a), len(b))
    return int(np.abs(a.reshape(-1, groups).sum(axis=0) - b.reshape(-1, groups).sum(axis=0)).sum())


def band_of(size: np.ndarray) -> np.ndarray:
    """Band k holds the sizes from 4**k to 4**(k + 1) - 1."""
    return ((np.frexp(size.astype(np.float64))[1] - 1) // 2).astype(np.int64)


def segment_count(band: int) -> int:
    low = 4 ** band
    return 1 << 32 if low < ORDERED_FROM else max(FEW_SEGMENTS if low < 256 else 0, 2 * low)


def roles(size: np.ndarray, percent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sets, band, H) under which sets are indexed: their own band, and the one
    below if a smaller partner can lie there."""
    some = np.flatnonzero(size > 0)
    n = size[some]
    band = band_of(n)
    least = 4 ** band
    own = (100 - percent) * (n + n * 100 // percent) // (100 + percent)
    low = -(-n * percent // 100) < least
    below = (100 - percent) * (n[low] + least[low] - 1) // (100 + percent)
    return [(some, band, own), (some[low], band[low] - 1, below)]


def _salt(band: int, factor: int) -> np.uint64:
    return _U((band + 1) * factor % (1 << 64))


def _segments(values: np.ndarray, band: int) -> np.ndarray:
    return (T.mix(values + _salt(band, 0xA0761D6478BD642F)) & _U(segment_count(band) - 1)).astype(np.int64)


def entries(sets: Sets, which: np.ndarray, band: int, bound: np.ndarray, plan,
            common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(entry, set) pairs of the index for some sets of one band. ``plan``: each
    segment's place in the order and its units, or None. ``common``: bit map of
    the entries that come last; every segment then counts one unit."""
    values, owner = sets.take(which)
    segment = _segments(values, band)
    place, units = (plan[0][segment], plan[1][segment]) if plan else (segment, None)
    order = np.argsort(owner << 33 | place, kind="stable")
    values, owner, segment, place = values[order], owner[order], segment[order], place[order]
    start = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(segment) != 0)))
    size = np.diff(np.append(start, len(values)))
    mixed = T.mix(values ^ _U(0x9FB21C651E98DF25))
    content = np.add.reduceat(mixed, start)
    item_owner = owner[start]
    salt = T.mix(segment[start].astype(_U) + _salt(band, 0xE7037ED1A0B428DB))
    entry = T.mix(content + salt)
    unit = np.ones(len(start), np.int64)
    if common is not None:
        last = _marked(common, entry)
        order = np.argsort(item_owner << 34 | last.astype(np.int64) << 33 | place[start], kind="stable")
        item_owner, entry = item_owner[order], entry[order]
    elif units is not None:
        unit[(units[order][start] == 2) & (size >= 2)] = 2
    total = np.cumsum(unit)
    before = total - unit
    first = np.searchsorted(item_owner, np.arange(len(which)))
    end = np.searchsorted(item_owner, np.arange(len(which)), side="right") - 1
    if (total[end] - before[first] <= bound).any():
        raise RuntimeError("a set fills too few segments; choose more segments for its band")
    use = before - before[first][item_owner] <= bound[item_owner]
    found, owners = [entry[use]], [item_owner[use]]
    if (two := use & (unit == 2)).any():
        item = np.repeat(np.arange(len(start)), size)
        own = two[item]
        found.append(T.mix(content[item[own]] - mixed[own] + salt[item[own]]))
        owners.append(owner[own])
    return np.concatenate(found), which[np.concatenate(owners)]


# ---- bit maps of bounded size -------------------------------------------------

MAP_BITS = 1 << 26       # of a map of entries
MOST_MAP_BITS = 1 << 28  # of a map of doc_ids: 32 MB
MOST_MARKED = 1 << 26    # doc_ids, from which on a join takes the place of a map


def map_bits(n: int) -> int:
    """Bits of a map of ``n`` doc_ids: 16 or more for each, up to the bound."""
    return min(1 << max(20, (16 * n).bit_length()), MOST_MAP_BITS)


def _bit(values: np.ndarray, size: int) -> np.ndarray:
    return (T.mix(values.astype(np.int64).view(_U)) & _U(size - 1)).astype(np.int64)


def _marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = _bit(values, 64 * len(bits))
    return bits[at >> 6] >> (at & 63) & 1 > 0


def _bit_map(ids: DataFrame, size: int = MAP_BITS) -> np.ndarray:
    """Bit map of a column of bigints: ``size`` bits, however many there are."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bit(batch.column(0).to_numpy(), size))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((at & 63).astype(np.int32))], ["word", "bit"])

    one = F.lit(1).cast("bigint")
    words = ids.mapInArrow(bits, "word bigint, bit int").groupBy("word").agg(
        F.bit_or(F.call_function("shiftleft", one, F.col("bit"))).alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


# ---- passes over the documents ---------------------------------------------

DESCRIBED = "doc_id bigint, size bigint, print1 bigint, print2 bigint, outline binary, band int, block int, filled binary"


def _describe(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """A row for each document (its set's size and prints), and each task's counts
    of filled segments in blocks (doc_id null, band not)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(1), lower=True, size=SLICE_BYTES):
                sets = Sets(buf, offsets, width)
                p1, p2 = sets.prints()
                for which, bands, _ in roles(sets.size, percent):
                    new = _first_of_kind(seen, sets.size, p1, p2, which)
                    for k in np.unique(bands).tolist():
                        if 4 ** k >= ORDERED_FROM:
                            values, owner = sets.take(which[(bands == k) & new])
                            m = segment_count(k)
                            filled = np.unique(owner * m + _segments(values, k)) % m
                            counts[k] = counts.get(k, 0) + np.bincount(filled, minlength=m)
                seen.update(zip(sets.size.tolist(), p1.tolist(), p2.tolist()))
                none = pa.nulls(b - a, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sets.size), pa.array(p1.view(np.int64)),
                     pa.array(p2.view(np.int64)), pa.array(sets.outlines(), pa.binary()), none, none, pa.nulls(b - a, pa.binary())], _NAMES)
        for k, c in counts.items():
            blocks = c.astype("<i8").reshape(-1, STATS_BLOCK)
            some = np.flatnonzero(blocks.any(axis=1))
            no = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [no, no, no, no, pa.nulls(len(some), pa.binary()), pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int32)),
                 pa.array([blocks[i].tobytes() for i in some], pa.binary())], _NAMES)

    _NAMES = [x.split()[0] for x in DESCRIBED.split(", ")]
    return _texts(docs).mapInArrow(T.tidy(run), DESCRIBED)


def _texts(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def _first_of_kind(seen: set, size, p1, p2, which: np.ndarray) -> np.ndarray:
    """Which of the sets are neither in ``seen`` nor equal to one before them."""
    here: set = set()
    out = np.empty(len(which), bool)
    for i, w in enumerate(which.tolist()):
        key = (int(size[w]), int(p1[w]), int(p2[w]))
        out[i] = key not in seen and key not in here
        here.add(key)
    return out


def _plans(described: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Order and units of the segments of each band. What comes to the driver is
    two counters for each shingle of the longest document, however many there are."""
    def add(key: tuple, frames: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<i8") for x in frames["filled"])
        return pd.DataFrame({"band": [key[0]], "block": [key[1]], "filled": [total.tobytes()]})

    rows = described.where("band IS NOT NULL").select("band", "block", "filled").groupBy("band", "block").applyInPandas(
        add, "band int, block int, filled binary").collect()
    out = {}
    for band in {r["band"] for r in rows}:
        filled = np.zeros(segment_count(band), np.int64)
        for r in rows:
            if r["band"] == band:
                filled[r["block"] * STATS_BLOCK:(r["block"] + 1) * STATS_BLOCK] = np.frombuffer(r["filled"], "<i8")
        out[band] = allocation(filled)
    return out


def allocation(filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the order, units) of each segment, from the sets that fill it."""
    usual = np.median(filled)
    excess = filled - usual
    excess[excess <= 6 * np.sqrt(usual + 1) + 2] = 0
    order = np.argsort(excess, kind="stable")
    units = np.ones(len(filled), np.int8)
    hot = np.sort(excess[excess > 0])[::-1]
    light = np.flatnonzero(excess == 0)
    light = light[np.argsort(filled[light], kind="stable")][:len(hot)]
    # a second unit in the lightest segments for each hot one that is dearer to check
    gain = CHECK_COST * hot[:len(light)] > 4 * (filled[light] + 1)
    units[light[gain]] = 2
    order = np.concatenate([light[gain], order[units[order] == 1]])
    place = np.empty(len(filled), np.int64)
    place[order] = np.arange(len(filled))
    return place, units


INDEXED = "part int, base bigint, entries binary, owners binary"


def _index(docs: DataFrame, plans, parts: int, width: int, percent: int, only_docs: np.ndarray | None = None,
           common: np.ndarray | None = None) -> DataFrame:
    """Index entries in packed lists, one for each task and part: the entries and
    the doc_ids (as offsets from ``base``) they belong to. Of equal sets of a task
    only the first is indexed. ``only_docs``: bit map of the doc_ids to index."""
    sent = docs.sparkSession.sparkContext.broadcast((plans, only_docs, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int, int]] = set()
        found, owners, held = [], [], 0
        plans, only_docs, common = sent.value
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            if only_docs is not None:
                batch = batch.filter(pa.array(_marked(only_docs, batch.column(0).to_numpy())))
            ids = batch.column(0).to_numpy()
            for a, b, buf, offsets in T.slices(batch.column(1), lower=True, size=SLICE_BYTES):
                sets = Sets(buf, offsets, width)
                p1, p2 = sets.prints()
                new = _first_of_kind(seen, sets.size, p1, p2, np.arange(b - a))
                seen.update((int(s), int(x), int(y)) for s, x, y, n in zip(sets.size, p1, p2, new) if n)
                for which, bands, bound in roles(sets.size, percent):
                    for k in np.unique(bands).tolist():
                        own = (bands == k) & new[which]
                        if own.any():
                            e, o = entries(sets, which[own], k, bound[own], plans.get(k), common)
                            found.append(e)
                            owners.append(ids[a:b][o])
                            held += len(e)
                if held >= SEND_ENTRIES:
                    yield from _packed(found, owners, parts)
                    found, owners, held = [], [], 0
        if held:
            yield from _packed(found, owners, parts)

    return _texts(docs).mapInArrow(T.tidy(run), INDEXED)


def _packed(found: list[np.ndarray], owners: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    entry, owner = np.concatenate(found), np.concatenate(owners).astype(np.int64)
    part = (entry >> _U(32)) * _U(parts) >> _U(32)
    order = np.argsort(part, kind="stable")
    entry, owner = entry[order], owner[order]
    ends = np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))
    base = int(owner.min())
    kind = "<u4" if int(owner.max()) - base < 1 << 32 else "<u8"
    small = (owner - base).astype(kind)
    some = [(p, a, b) for p, (a, b) in enumerate(zip([0, *ends.tolist()], ends.tolist())) if b > a]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _, _ in some], pa.int32()), pa.array([base] * len(some), pa.int64()),
         pa.array([entry[a:b].tobytes() for _, a, b in some], pa.binary()),
         pa.array([small[a:b].tobytes() for _, a, b in some], pa.binary())], ["part", "base", "entries", "owners"])


CANDIDATES = "a bigint, b bigint, bucket bigint, members binary, entries binary"


def _meet(frames: pd.DataFrame) -> pd.DataFrame:
    """Candidate pairs of one part, and the members of its large buckets with the
    entries that have just these members, in rows of at most ``CELL_VALUES`` each."""
    entry = np.frombuffer(b"".join(frames["entries"]), _U)
    owner = np.concatenate([np.frombuffer(o, np.dtype(f"<u{8 * len(o) // len(e)}")).astype(np.int64) + base
                            for o, e, base in zip(frames["owners"], frames["entries"], frames["base"])])
    order = np.lexsort((owner, entry))
    entry, owner = entry[order], owner[order]
    new = np.append(True, (entry[1:] != entry[:-1]) | (owner[1:] != owner[:-1]))
    entry, owner = entry[new], owner[new]
    start = np.flatnonzero(np.append(True, entry[1:] != entry[:-1]))
    size = np.diff(np.append(start, len(entry)))
    large = size > SMALL_BUCKET
    bucket = np.repeat(np.arange(len(start)), size)
    pairs = []
    for step in range(1, SMALL_BUCKET):
        i = np.flatnonzero((bucket[step:] == bucket[:-step]) & ~large[bucket[step:]]) if len(bucket) > step else []
        if not len(i):
            break
        pairs.append(np.stack([owner[i], owner[i + step]], axis=1))
    tied = np.flatnonzero(large[bucket])
    tied = tied[start[bucket[tied]] != tied]
    pairs.append(np.stack([owner[start[bucket[tied]]], owner[tied]], axis=1))
    both = np.unique(np.concatenate(pairs), axis=0)
    lists: dict[bytes, list[int]] = {}
    for i in np.flatnonzero(large).tolist():
        lists.setdefault(owner[start[i]:start[i] + size[i]].astype("<i8").tobytes(), []).append(start[i])
    buckets, members, entries = [], [], []
    for ids, at in lists.items():
        # a sum over the members stands for them
        bucket = int(T.mix(np.frombuffer(ids, _U)).sum(dtype=_U).astype(np.int64))
        for cells, blob in ((members, ids), (entries, entry[at].tobytes())):
            parts = [blob[i:i + 8 * CELL_VALUES] for i in range(0, len(blob), 8 * CELL_VALUES)]
            buckets += [bucket] * len(parts)
            cells += parts
            (entries if cells is members else members).extend([None] * len(parts))
    return pd.DataFrame({"a": pd.array([*both[:, 0], *[None] * len(buckets)], "Int64"),
                         "b": pd.array([*both[:, 1], *[None] * len(buckets)], "Int64"),
                         "bucket": pd.array([*[None] * len(both), *buckets], "Int64"),
                         "members": [None] * len(both) + members, "entries": [None] * len(both) + entries})


# ---- verification -----------------------------------------------------------

def _possible(pairs: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and outlines don't rule out."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            good = 100 * np.minimum(m, n) >= percent * np.maximum(m, n)
            most = (100 - percent) * (m + n) // (100 + percent)
            x, y = batch.column(4), batch.column(5)
            for i in np.flatnonzero(good).tolist():
                a, b = x[i].as_py(), y[i].as_py()
                good[i] = a is None or b is None or differences(a, b) <= most[i]
            yield batch.select(["a", "b"]).filter(pa.array(good))

    def side(name: str) -> DataFrame:
        return described.where("band IS NULL").select(F.col("doc_id").alias(name), F.col("size").alias(f"size_{name}"),
                                                      F.col("outline").alias(f"outline_{name}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "size_a", "size_b", "outline_a", "outline_b")
    return saved(both.mapInArrow(T.tidy(check), "a bigint, b bigint"), "jaccard-possible")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets, given as distinct values, link."""
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _sets_of(docs: DataFrame, ids: DataFrame, most: int, width: int) -> DataFrame:
    """(id, values): the whole sets of the documents in ``ids`` (at most ``most``
    distinct ones), and of a few others, which the caller's join drops.

    A bit map filled from the ids keeps most others back. Where there may be more than
    ``MOST_MARKED`` ids, the texts are joined with them instead.
    """
    texts, marks = _texts(docs), None
    if most > MOST_MARKED:
        texts = texts.join(ids, texts["doc_id"] == ids["id"], "left_semi")
    else:
        marks = _bit_map(ids, map_bits(most))
    sent = docs.sparkSession.sparkContext.broadcast(marks)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(batch.column(0).is_valid())
            if sent.value is not None:
                some = some.filter(pa.array(_marked(sent.value, some.column(0).to_numpy())))
            for a, b, buf, offsets in T.slices(some.column(1), lower=True, size=SLICE_BYTES):
                sets = Sets(buf, offsets, width)
                blobs = [sets.values[e - n:e].tobytes() for e, n in zip(sets.ends.tolist(), sets.size.tolist())]
                yield pa.RecordBatch.from_arrays([some.column(0).slice(a, b - a), pa.array(blobs, pa.binary())], ["id", "values"])

    return texts.mapInArrow(T.tidy(send), "id bigint, values binary")


def _verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose whole sets are similar enough."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                good[i] = similar(np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    sets = _sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), 2 * pairs.count(), width)
    left = pairs.join(sets.select(F.col("id").alias("b"), F.col("values").alias("y")), "b")
    full = left.join(sets.select(F.col("id").alias("a"), F.col("values").alias("x")), "a").select("a", "b", "x", "y")
    return saved(full.mapInArrow(T.tidy(check), "a bigint, b bigint"), "jaccard-links")


# ---- the operator -----------------------------------------------------------

def similar_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable)."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    spark = docs.sparkSession
    described = saved(_describe(docs, width, percent), "jaccard-sets")
    sets = described.where("band IS NULL").select("doc_id", "size", "print1", "print2")
    total = sets.agg(F.sum("size")).first()[0] or 0
    parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), int(0.4 * total) // PART_ENTRIES + 1)

    kinds = saved(sets.where("size > 0 AND doc_id IS NOT NULL").groupBy("size", "print1", "print2").agg(
        F.min("doc_id").alias("label"), F.max("doc_id").alias("_last")).where("label <> _last").drop("_last"), "jaccard-classes")
    copies = saved(sets.join(sized(kinds), ["size", "print1", "print2"]).where("doc_id <> label").select(
        F.col("doc_id").alias("node"), "label"), "jaccard-copies")

    # a node may have several classes if its doc_id repeats
    to_class = sized(saved(copies.groupBy("node").agg(F.min("label").alias("label")), "jaccard-copies"))
    labels = saved(to_class.unionByName(kinds.select(F.col("label").alias("node"), "label")), "labels")
    nodes = labels.select("node").distinct().count()
    if copies.count() == to_class.count() and nodes == labels.count():
        labels = sized(labels)
    else:  # a doc_id repeats and ties classes together
        labels = sized(components(copies.select(F.col("label").alias("a"), F.col("node").alias("b"))))
    # a doc_id with other texts besides stands for all of them in its pairs
    contents = F.struct("size", "print1", "print2")
    several = sets.where("size > 0").join(to_class, sets["doc_id"] == to_class["node"], "left_semi").groupBy("doc_id").agg(
        F.min(contents).alias("x"), F.max(contents).alias("y")).where("x <> y").select(F.col("doc_id").alias("node"))
    to_class = sized(saved(to_class.join(sized(saved(several, "jaccard-copies")), "node", "left_anti"), "jaccard-copies"))
    plans, only_docs, common, last = _plans(described), None, None, None
    while True:
        index = _index(docs, plans, parts, width, percent, only_docs, common)
        met = saved(index.groupBy("part").applyInPandas(_meet, CANDIDATES), "jaccard-candidates")
        pairs = relabel(relabel(met.where("a IS NOT NULL").select("a", "b"), "a", to_class), "b", to_class)
        labels = _linked(docs, pairs, described, labels, width, percent)
        rows, found = _mixed(met, to_class, labels)
        if rows is None:
            break
        new, size = _bit_map(found), rows.count()
        if last is not None and size > THINNED * last:
            labels = _with_links(labels, _between(docs, rows, described, width, percent))
            break
        last = size
        only_docs = _bit_map(rows.select("id").distinct(), map_bits(size))
        common = new if common is None else new | common

    out = sets.select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return relabel(out, "component_id", labels)


def _linked(docs: DataFrame, pairs: DataFrame, described: DataFrame, labels: DataFrame, width: int, percent: int) -> DataFrame:
    """``labels`` (node, label) after the links among ``pairs``; pairs within one
    component are passed over."""
    ends = relabel(relabel(pairs.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y")), "x", labels), "y", labels)
    apart = ends.where("x <> y").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return _with_links(labels, _verified(docs, _possible(apart, described, percent), width, percent))


def _with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after the links (a, b)."""
    if links.isEmpty():
        return labels
    ends = relabel(relabel(links, "a", labels), "b", labels)
    new = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(new.select("node", F.col("node").alias("label")))
    return sized(saved(relabel(every, "label", sized(components(ends))), "labels"))


def _mixed(met: DataFrame, to_class: DataFrame, labels: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """(bucket, id, label) of the large buckets that span components, and their
    entries."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, blob in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(blob.as_py(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), bucket.as_py())), pa.array(ids)], ["bucket", "id"])

    unpacked = met.where("members IS NOT NULL").select("bucket", "members").mapInArrow(T.tidy(unpack), "bucket bigint, id bigint")
    rows = relabel(unpacked, "id", to_class).withColumn("label", F.col("id"))
    rows = saved(relabel(rows, "label", labels), "jaccard-buckets")
    mixed = saved(rows.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("bucket"),
                  "jaccard-mixed")
    if mixed.isEmpty():
        return None, None
    own = saved(rows.join(sized(mixed), "bucket").distinct(), "jaccard-mixed")
    found = met.where("entries IS NOT NULL").join(sized(mixed), "bucket").select("bucket", "entries").mapInArrow(
        T.tidy(unpack), "bucket bigint, id bigint")
    return own, found.select("id")


def _merged(rows: DataFrame) -> DataFrame:
    """``rows`` (bucket, id, label) with buckets that overlap made one. Two members that
    shared a bucket still do. In each turn the buckets with the same least member, by a
    hash of the turn, are merged if comparing them at once takes no more than one by one."""
    def costs(rows: DataFrame) -> DataFrame:
        n = F.sum("n")
        return rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
            (n * (n - F.max("n") + CHECK_COST)).alias("cost"))

    count, turn = rows.count(), 0
    while True:
        least = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("hash"), "id"))["id"]
        own = rows.groupBy("bucket").agg(least.alias("least")).join(costs(rows), "bucket").select(
            "bucket", F.xxhash64("least", F.lit(turn)).alias("to"), "cost")
        own = sized(saved(own, "jaccard-merged"))
        several = own.groupBy("to").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("before")).where("n > 1")
        tried = rows.join(own, "bucket").select(F.col("to").alias("bucket"), "id", "label").distinct()
        good = sized(saved(costs(saved(tried, "jaccard-merged")).withColumnRenamed("bucket", "to").join(several, "to").where(
            "cost <= before").select("to"), "jaccard-merged"))
        to = own.join(good, "to", "left_semi").select("bucket", "to")
        rows = saved(rows.join(to, "bucket", "left").select(F.coalesce("to", "bucket").alias("bucket"), "id", "label").distinct(),
                     "jaccard-buckets")
        before, count, turn = count, rows.count(), turn + 1
        if count > MERGED * before:
            return rows


def _between(docs: DataFrame, rows: DataFrame, described: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that join all components which links within a bucket join. Members
    of a bucket's largest component are never compared with each other: only the others
    visit the members of all size ranges that they may link with. Both sides of a range
    are dealt by hash into blocks of bounded count and size, and a task holds two of them
    with their whole sets. It verifies the pairs that sizes and outlines allow, passes
    over those already joined by its links, and gives fewer links than it has members."""
    described = described.where("band IS NULL AND doc_id IS NOT NULL").withColumnRenamed("doc_id", "id")
    rows = _merged(rows)
    of_label = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = saved(of_label.groupBy("bucket").agg(F.max(F.struct("n", "label"))["label"].alias("largest")), "jaccard-mixed")
    members = saved(rows.join(sized(largest), "bucket").join(described.select("id", "size").distinct(), "id").select(
        "bucket", "id", "label", "size", (F.col("label") != F.col("largest")).alias("apart")), "jaccard-members")

    def size_range(size, slack: float = 0.0):
        return F.floor(F.log(size) / math.log(SIZE_STEP) + slack)

    size = F.col("size")
    home = members.withColumn("range", size_range(size))
    away = members.where("apart").withColumn("range", F.explode(F.sequence(
        size_range(size * percent / 100, -1e-9), size_range(size * 100 / percent, 1e-9))))
    longest = F.pow(F.lit(SIZE_STEP), F.col("range") + 1)
    some = F.greatest(F.lit(1), F.least(F.lit(BLOCK_MEMBERS), F.floor(BLOCK_VALUES / longest)))
    blocks = F.ceil(F.count(F.lit(1)) / F.first(some)).cast("int")
    place = ["bucket", "range"]
    ranges = sized(saved(home.groupBy(*place).agg(blocks.alias("homes")).join(
        away.groupBy(*place).agg(blocks.alias("visits")), place), "jaccard-ranges"))
    key = [*place, "block", "visit"]
    stays = home.join(ranges, place).withColumn("block", F.pmod(F.xxhash64("id"), "homes").cast("int")).withColumn(
        "visit", F.explode(F.sequence(F.lit(0), F.col("visits") - 1)))
    comes = away.join(ranges, place).withColumn("visit", F.pmod(F.xxhash64("id", F.lit("visit")), "visits").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
    columns = [*key, "id", "label", "size", "apart"]
    dealt = stays.select(*columns, F.lit(False).alias("visitor")).unionByName(comes.select(*columns, F.lit(True).alias("visitor")))
    ids = members.select("id").distinct()
    sets = _sets_of(docs, ids, ids.count(), width).dropDuplicates(["id", "values"]).withColumn(
        "size", (F.length("values") / 8).cast("bigint"))
    dealt = dealt.join(sets, ["id", "size"])

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(v, _U) for v in frame["values"]]
        flat = np.stack([np.bincount((v & _U(63)).astype(np.int64), minlength=64) for v in sets])
        if flat.max(initial=0) < 1 << 14:
            flat = flat.astype(np.int16)  # differences and their sums stay small
        ids, label, n, apart, visitor = (frame[c].to_numpy() for c in ("id", "label", "size", "apart", "visitor"))
        joined = label.copy()
        home = np.flatnonzero(~visitor)
        out: list[tuple[int, int]] = []
        for x in np.flatnonzero(visitor).tolist():
            # two that both visit meet twice; the smaller id's visit counts
            y = home[(joined[home] != joined[x]) & (~apart[home] | (ids[home] > ids[x]))]
            y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
            most = (100 - percent) * (n[y] + n[x]) // (100 + percent)
            apart_by = np.abs(flat[y] - flat[x]).sum(axis=1, dtype=np.int64)
            for k in y[apart_by <= most][np.argsort(apart_by[apart_by <= most], kind="stable")].tolist():
                if joined[k] != joined[x] and similar(sets[x], sets[k], percent):
                    out.append((min(ids[x], ids[k]), max(ids[x], ids[k])))
                    joined[joined == joined[k]] = joined[x]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return saved(dealt.groupBy(*key).applyInPandas(compare, "a bigint, b bigint").distinct(), "jaccard-links")
