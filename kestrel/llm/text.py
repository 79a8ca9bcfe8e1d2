"""Word scanning over UTF-8 bytes with numpy, for use inside Spark tasks.

A batch of texts is one byte buffer; a word is a maximal run of bytes for which
a 256-entry table is true. All separators of the two word definitions used here
are ASCII, so scanning bytes gives the same words as scanning code points.

Words get a 64-bit polynomial hash of their bytes (finished with a mixer).
Batches are processed in slices of about ``SLICE_BYTES``; one text is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
HASH_BYTES = 1 << 18  # bytes hashed in one go; two numbers are held for each

# Arrow's own allocator keeps what is freed. Python workers share an executor's
# memory and live long, so freed batches go back to the system.
pa.set_memory_pool(pa.system_memory_pool())

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None


def give_back() -> None:
    """Memory freed in this process goes back to the system."""
    if _trim:
        _trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` from batches to batches, which gives freed memory back to the system
    when a task ends: an idle worker waits for its next task with little."""
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

# Byte tables of the two word definitions (fixed by the query contracts).
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTER_DIGIT = np.zeros(256, bool)  # after A-Z is lower-cased
LETTER_DIGIT[0x30:0x3A] = LETTER_DIGIT[0x61:0x7B] = LETTER_DIGIT[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (xor-shift, multiply), elementwise."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_tables: tuple[np.ndarray, np.ndarray] | None = None


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """p**i and p**-i for i below HASH_BYTES, modulo 2**64."""
    global _tables
    if _tables is None:
        def powers(base: int) -> np.ndarray:
            out = np.full(HASH_BYTES, base, _U)
            out[0] = 1
            return np.multiply.accumulate(out)
        _tables = powers(_BASE), powers(_BASE_INV)
    return _tables


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes buf[start:end] of every (ascending, disjoint) span."""
    up, down = _powers()
    out = np.empty(len(start), _U)
    i, n = 0, len(start)
    while i < n:
        first = int(start[i])
        j = int(np.searchsorted(end, first + HASH_BYTES, side="right"))
        if j <= i:  # one span longer than that
            total, scale = 0, 1
            for at in range(first, int(end[i]), HASH_BYTES):
                part = buf[at:min(at + HASH_BYTES, int(end[i]))].astype(_U) + _U(1)
                total += scale * int((part * up[:len(part)]).sum(dtype=_U))
                scale = scale * pow(_BASE, HASH_BYTES, 1 << 64) % (1 << 64)
            out[i] = total % (1 << 64)
            i += 1
            continue
        last = int(end[j - 1])
        sums = np.zeros(last - first + 1, _U)
        np.cumsum((buf[first:last].astype(_U) + _U(1)) * up[:last - first], out=sums[1:])
        s, e = start[i:j] - first, end[i:j] - first
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out)


class Words:
    """Words of a slice of texts: byte positions, hashes, and each text's range."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.buf, self.offsets = buf, offsets
        n = len(buf)
        inside = table[buf]
        before = np.zeros(n, bool)
        after = np.zeros(n, bool)
        if n:
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
            edges = offsets[(offsets > 0) & (offsets < n)]
            before[edges] = False
            after[edges - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        #: words of text i are first[i]:first[i + 1]
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column, lower: bool, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, past the last text, bytes, offsets) for slices of a column."""
    buf, offsets = text_buffers(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1
        b = min(max(b, a + 1), n)
        part = buf[offsets[a]:offsets[b]]
        yield a, b, (_LOWER[part] if lower else part), offsets[a:b + 1] - offsets[a]
        a = b


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of every ``width`` consecutive entries of ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.zeros(n, _U)
    factor = 1
    for k in range(width):
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        out += h[k:k + n] * _U(factor)
    return mix(out + _U(width))
