"""Token counts of every prefix (operator 9).

Prefix dynamic programming: in byte-pair encoding the last token of a prefix is
the one token ending there that stays whole beside the last token of what comes
before it, so one pass over a piece yields the exact token count of each of its
prefixes. A text's table is the tables of its chunks, shifted. With it, the
count of any prefix, a cut at a token budget and the tokens left over are
lookups; nothing is encoded again.

Null text counts as empty: no tokens. Repeated rows give repeated results; an
empty table gives an empty result; columns besides the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bpe
from . import text as T
from .common import only


def _count_slice(counter: bpe.PrefixCounter, buf, offsets, limit: int):
    """(tokens, bytes of the longest prefix within the limit) of each text."""
    start, first, kind, values = counter.distinct_chunks(buf, offsets)
    size = np.array([v[-1] for v in values], np.int64)
    sums = np.concatenate([[0], np.cumsum(size[kind])]) if len(kind) else np.zeros(1, np.int64)
    tokens = np.diff(sums[first])
    fits = np.diff(offsets).copy()
    for i in np.flatnonzero(tokens > limit):
        # the first chunk that passes the limit holds the longest prefix within it
        base = sums[first[i]]
        c = int(np.searchsorted(sums[first[i]:first[i + 1] + 1], base + limit, side="right")) - 1 + int(first[i])
        counts = values[kind[c]]
        at = int(start[c])
        ok = np.flatnonzero(counts <= limit - (sums[c] - base))
        ok = ok[(buf[np.minimum(at + ok, len(buf) - 1)] & 0xC0 != 0x80) | (at + ok == offsets[i + 1])]
        fits[i] = at - offsets[i] + ok[-1]
    return tokens, fits


def token_counts(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit, and limit_bytes, the length of
    the text's longest prefix of at most ``limit`` tokens."""
    kind = only(docs, id_col, text_col)
    out = f"{id_col} {kind.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean, limit_bytes bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = bpe.shared(bpe.PrefixCounter, tokenizer)
        for batch in batches:
            ids = batch.column(0)
            for a, b, buf, offsets in T.slices(batch.column(1), lower=False):
                tokens, fits = _count_slice(counter, buf, offsets, limit)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit),
                     pa.array(fits)], [id_col, "n_bytes", "n_tokens", "over_limit", "limit_bytes"])

    return kind.mapInArrow(count, out)


def prefix_tables(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and prefix_tokens, whose entry i is the exact token count of
    the text's first i bytes (for places between characters)."""
    kind = only(docs, id_col, text_col)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = bpe.shared(bpe.PrefixCounter, tokenizer)
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                counts = counter.prefix_counts(text.as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([counts], pa.list_(pa.int32()))], [id_col, "prefix_tokens"])

    return kind.mapInArrow(table, f"{id_col} {kind.schema[id_col].dataType.simpleString()}, prefix_tokens array<int>")
