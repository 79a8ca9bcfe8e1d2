"""Language identification (operator 7): prediction by partial matching.

For each language a context tree of bytes, up to ``ORDER`` deep, is counted on a
training sample; escapes are by method C (distinct successors against occurrences)
and the statistics are frozen. A text's code length under a language is the sum
over its bytes: where the byte followed the longest known context, the cost of
that; where not, the cost of the escape and of the byte in the context one
shorter, down to a flat code over all bytes. The shortest code wins.

The trees are laid out as tables: one row for every context-and-byte or context
that any language has seen, one column for each language, with escapes already
added up, so scoring is a search for each byte in the sorted codes. Every byte is
its own symbol.

Training rows: the distinct texts of a language by smallest hash, at most
``sample_docs``, until they have ``sample_bytes`` bytes together. Each is counted
whole, copies of it once. That bound is on the training sample alone; whole texts
are scored.

A null text, or one without a letter, is ``und`` with score 0. A tie goes to the
language first in the alphabet. Repeated rows give repeated results. Without a
training row ``predict`` gives ``und`` for every text. Other columns than those named are ignored by
``predict`` and kept by ``identified``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import text as T
from .common import only

SLICE_BYTES = 1 << 19  # some ten numbers are held for a byte
ORDER = 3
SYMBOL_BITS = 8
SAMPLE_DOCS = 400
SAMPLE_BYTES = 16 << 20
UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def training_sample(docs: DataFrame, use: Column, text_col: str = "text", lang_col: str = "lang",
                    sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(lang, data): at most ``sample_docs`` distinct whole texts of each language
    among the rows where ``use`` is true, no more after they have ``sample_bytes``
    bytes together. Hashes are picked in two rounds, so that no task ranks them all; only
    the picked texts are moved."""
    rows = docs.where(use & docs[lang_col].isNotNull() & (F.octet_length(docs[text_col]) > 0)).select(
        docs[lang_col].alias("lang"), F.xxhash64(docs[text_col]).alias("h"), docs[text_col].alias("text"))
    prints = rows.groupBy("lang", "h").agg(F.min(F.octet_length("text")).alias("n"))
    prints = prints.withColumn("task", F.pmod(F.xxhash64("h"), F.lit(256)))
    for keys in (["lang", "task"], ["lang"]):
        best = Window.partitionBy(*keys).orderBy("h")
        prints = prints.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= sample_docs).drop("rank")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    picked = prints.withColumn("before", before).where(F.col("before") < sample_bytes).select("lang", "h")
    found = rows.join(F.broadcast(picked), ["lang", "h"]).dropDuplicates(["lang", "h"])
    return found.select("lang", F.encode("text", "UTF-8").alias("data"))


class Model:
    """Frozen context trees of some languages, as lookup tables."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.langs = sorted(samples)
        self.symbol = np.arange(1 << SYMBOL_BITS)
        n = len(self.langs)
        #: by context length: the codes of each (context, byte) that some language
        #: has seen, their bits in every language, the contexts and the bits of
        #: escaping from them
        self.codes: list[np.ndarray] = []
        self.bits: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.escape: list[np.ndarray] = []
        for order in range(ORDER + 1):
            grams = [self._grams(samples[x], order) for x in self.langs]
            some = np.unique(np.concatenate([c for c, _ in grams])) if grams else np.empty(0, np.int64)
            contexts, context = np.unique(some >> SYMBOL_BITS, return_inverse=True)
            escapes = np.zeros((len(contexts), n), np.float32)
            bits = np.empty((len(some), n), np.float32)
            shorter = self._lookup(order - 1, some & ((1 << SYMBOL_BITS * order) - 1)) if order else np.full((len(some), n), 8.0)
            for k, (codes, counts) in enumerate(grams):
                own = np.searchsorted(some, codes)
                total = np.bincount(context[own], weights=counts, minlength=len(contexts))
                kinds = np.bincount(context[own], minlength=len(contexts))
                known = kinds > 0
                escapes[known, k] = np.log2((total[known] + kinds[known]) / kinds[known])
                bits[:, k] = escapes[context, k] + shorter[:, k]
                bits[own, k] = np.log2((total + kinds)[context[own]] / counts)
            self.codes.append(some)
            self.bits.append(bits)
            self.contexts.append(contexts)
            self.escape.append(escapes)

    @staticmethod
    def _place(known: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Place of each code among the sorted known ones, or -1."""
        if not len(known):
            return np.full(len(codes), -1)
        row = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        return np.where(known[row] == codes, row, -1)

    def _grams(self, texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
        """(codes, counts) of what a language has seen."""
        parts = [np.unique(self._codes(self.symbol[np.frombuffer(d, np.uint8)], order), return_counts=True)
                 for d in texts if len(d) > order]
        codes, of = np.unique(np.concatenate([np.empty(0, np.int64), *(c for c, _ in parts)]), return_inverse=True)
        counts = np.concatenate([np.empty(0, np.int64), *(n for _, n in parts)])
        return codes, np.bincount(of, weights=counts, minlength=len(codes)).astype(np.int64)

    @staticmethod
    def _codes(symbols: np.ndarray, order: int) -> np.ndarray:
        """Code of every symbol with the ``order`` before it."""
        n = len(symbols) - order
        out = np.zeros(n, np.int64)
        for k in range(order + 1):
            out = out << SYMBOL_BITS | symbols[k:k + n]
        return out

    def _lookup(self, order: int, codes: np.ndarray) -> np.ndarray:
        """Bits of each code in every language."""
        row = self._place(self.codes[order], codes)
        out = self._taken(self.bits[order], row)
        lost = np.flatnonzero(row < 0)
        if len(lost):
            c = codes[lost]
            rest = self._lookup(order - 1, c & ((1 << SYMBOL_BITS * order) - 1)) if order else np.float32(8.0)
            context = self._place(self.contexts[order], c >> SYMBOL_BITS)
            out[lost] = self._taken(self.escape[order], context) + rest
        return out

    @staticmethod
    def _taken(table: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The rows of a table; zeros where a place is -1."""
        if not len(table):
            return np.zeros((len(row), table.shape[1]), np.float32)
        out = table[row]
        out[row < 0] = 0
        return out

    def code_lengths(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text of a slice under every language."""
        symbols = self.symbol[buf]
        sums = np.zeros((len(offsets) - 1, len(self.langs)))
        if not len(buf):
            return sums
        start = np.repeat(offsets[:-1], np.diff(offsets))
        inner = np.arange(len(buf)) - start
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for order in range(ORDER + 1):
            # the first bytes of a text have shorter contexts
            at = np.flatnonzero(inner == order) if order < ORDER else np.flatnonzero(inner >= order)
            for a in range(0, len(at), 1 << 18):
                part = at[a:a + (1 << 18)]
                code = symbols[part - order]
                for k in range(order - 1, -1, -1):
                    code = code << SYMBOL_BITS | symbols[part - k]
                bits = self._lookup(order, code)
                own = owner[part]
                first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
                if len(own):
                    sums[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.float64)
        return sums


def train(sample: DataFrame) -> Model:
    """The model of a bounded sample (lang, data)."""
    samples: dict[str, list[bytes]] = {}
    for r in sample.toLocalIterator():
        samples.setdefault(r["lang"], []).append(bytes(r["data"]))
    return Model(samples)


def judged(model: Model, column) -> tuple[list[str], np.ndarray]:
    """(language, score) of every text of an Arrow column."""
    langs: list[str] = []
    scores = []
    texts = column.to_pylist()
    for a, b, buf, offsets in T.slices(column, lower=False, size=SLICE_BYTES):
        if model.langs:
            bits = model.code_lengths(buf, offsets)
            best = bits.argmin(axis=1)
            # share of the winner if every language were equally likely
            score = 1 / np.exp2(np.minimum(bits.min(axis=1, keepdims=True) - bits, 0)).sum(axis=1)
        letters = np.array([bool(model.langs) and has_letter(t) for t in texts[a:b]], bool)
        langs += [model.langs[best[i]] if letters[i] else UNKNOWN for i in range(b - a)]
        scores.append(np.where(letters, score, 0.0) if model.langs else np.zeros(b - a))
    return langs, np.concatenate(scores) if scores else np.empty(0)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = judged(sent.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [id_col, "lang_pred", "score"])

    return rows.mapInArrow(T.tidy(run), f"{id_col} {rows.schema[id_col].dataType.simpleString()}, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language is known, all their columns as they were. A model
    without languages rejects nothing but texts without a letter."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if sent.value.langs:
                keep = [x != UNKNOWN for x in judged(sent.value, batch.column(at))[0]]
            else:
                keep = [has_letter(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(T.tidy(run), docs.schema)
