"""Personal data (operator 13): character BiLSTM with CRF transitions.

Four base patterns give labelled spans. A sample of the documents' windows around
digits, ``@`` and ``[at]``, with the spans as labels, trains the tagger of
``tagger.py``; windows are also used with their spans rewritten (other separators,
``[at]`` for ``@``, numbers without ``+``) and with numbers that aren't personal put in
place of the spans. The tagger then finds what the patterns miss.

A text is cut into windows of ``WIDTH`` code points, each ``STEP`` after the one before.
A personal span must hold a trigger (a digit, ``@`` or ``[at]``), so windows without
one can't add any and aren't scored; all others are. What overlapping windows find is
reconciled over the whole text: spans of one kind that overlap where a window cut one of
them are joined, then the spans of largest total confidence without overlap are taken
that are plausible for their kind and touch no base span.

Spans are code points, end exclusive. Null text is empty; repeated rows give repeated
results; a table without spans to learn from gives base spans only; an empty table gives
an empty result; other columns are ignored by ``find`` and kept by ``masked``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tagger
from .common import only, saved

# Fixed values of the base patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
# ---

TRIGGER = re.compile(r"[0-9@]|[\[(]\x20?[aA][tT]\x20?[\])]")
WIDTH, STEP = 96, 48
BATCH = 256  # windows scored in step
LABELLED, UNLABELLED = 900, 300  # training windows with and without a span
MIN_CONFIDENCE = 0.8
MAX_CARD, MAX_PHONE = (16, 19), (8, 15)

Span = tuple[int, int, int]  # kind, start, end
Found = tuple[int, int, int, float]


# -- base patterns ------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` once: as far left as its local part goes, behind the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start."""
    if not TRIGGER.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p := g.lstrip("0")) < 3 or (len(p) == 3 and p <= "255") for g in m.groups())]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if MAX_CARD[0] <= len(digits) <= MAX_CARD[1] and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if MAX_PHONE[0] <= len(NOT_DIGIT.sub("", m[0])) <= MAX_PHONE[1]]
    return out


# -- windows and training rows ------------------------------------------------

def active_windows(text: str) -> list[int]:
    """Starts of the windows that hold a trigger."""
    starts, last = [], -1
    count = 1 + max(0, -(-(len(text) - WIDTH) // STEP))
    m = TRIGGER.search(text)
    while m:
        at = m.start()
        for w in range(max(last + 1, -(-(at - WIDTH + 1) // STEP)), min(count - 1, at // STEP) + 1):
            starts.append(w * STEP)
            last = w
        # on to what lies in a window that isn't taken yet
        m = TRIGGER.search(text, max(at + 1, min((last + 1) * STEP, (at // STEP + 1) * STEP)))
    return starts


def labelled_windows(docs: DataFrame, text_col: str) -> DataFrame:
    """(text, kinds, starts, ends): distinct active windows of all texts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                if not text or not TRIGGER.search(text):
                    continue
                spans = sorted(base_spans(text), key=lambda s: s[1])
                ends = np.array([s[2] for s in spans], np.int64)
                for a in active_windows(text):
                    own = []
                    for kind, x, y in spans[int(np.searchsorted(np.maximum.accumulate(ends), a, side="right")) if len(ends) else 0:]:
                        if x >= a + WIDTH:
                            break
                        if y > a and (not own or x - a >= own[-1][2]):
                            own.append((kind, max(x - a, 0), min(y - a, WIDTH)))
                    out.append((text[a:a + WIDTH], *(list(c) for c in (zip(*own) if own else ([], [], [])))))
            columns = list(zip(*out)) or [()] * 4
            kinds = [pa.string(), *[pa.list_(pa.int32())] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["text", "kinds", "starts", "ends"])

    rows = only(docs, text_col).mapInArrow(cut, "text string, kinds array<int>, starts array<int>, ends array<int>")
    return rows.groupBy("text").agg(*(F.min(c).alias(c) for c in ("kinds", "starts", "ends")))


def rewritten(kind: int, span: str, rng: Random) -> str:
    """Another way to write a span of that kind."""
    digits = NOT_DIGIT.sub("", span)
    if kind == 0:
        name, _, host = span.partition("@")
        at = rng.choice([" [at] ", "[at]", "(at)", " (at) ", " @ "])
        return name + at + (host.replace(".", rng.choice([" [dot] ", "[dot]", "(dot)", " . "])) if rng.random() < 0.5 else host)
    if kind == 1:
        return rng.choice(["[.]", "(.)", " . ", "[dot]"]).join(span.split("."))
    if kind == 2:
        return rng.choice([".", "/", "_", "  ", " - "]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"{a} {b} {c}", f"({a}){b}-{c}"])


def decoy(rng: Random) -> str:
    """A number or name with digits that isn't personal."""
    n = rng.randrange
    return rng.choice([
        f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}.{n(1, 13)}.{n(1990, 2030)}", f"{n(24)}:{n(60):02}:{n(60):02}",
        f"v{n(20)}.{n(20)}.{n(99)}", f"{n(9)}.{n(10 ** 6)}", f"{n(999)},{n(999):03},{n(999):03}", f"${n(9999)}.{n(100):02}", f"#{n(10 ** 6)}",
        f"{n(10 ** 9)}", f"{n(100)}%", f"{n(1, 200)}.", f"{n(1000)}-{n(2000)}", f"x{n(100)}y{n(100)}", f"{n(1 << 60):x}", f"{n(1 << 120):x}",
        f"@{rng.choice(['user', 'all', 'media', 'override'])}", f"{n(10 ** 15, 10 ** 16)}", f"ISBN {n(10 ** 12, 10 ** 13)}",
        "AKIA" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16)), f"{n(10)}.{n(10)}.{n(10)}"])


def training_rows(windows: list[tuple[str, list[Span]]], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and labels of the windows, of their rewritten forms and of decoys."""
    rng = Random(seed)
    texts = []
    for text, spans in windows:
        texts.append((text, spans))
        for change in (rewritten, None) if spans else (None,):
            out, at, own, size = [], 0, [], 0
            for kind, a, b in spans:
                whole = a > 0 and b < len(text)
                new = (change(kind, text[a:b], rng) if change else decoy(rng)) if whole else text[a:b]
                out += [text[at:a], new]
                size += a - at
                if change or not whole:
                    own.append((kind, size, size + len(new)))
                size, at = size + len(new), b
            if not spans:
                at = rng.randrange(len(text) + 1)
                out = [text[:at], f" {decoy(rng)} "]
            joined = "".join(out) + text[at:]
            shift = max(0, min((own[-1][2] if own else 0) - WIDTH, len(joined) - WIDTH))
            texts.append((joined[shift:shift + WIDTH], [(k, max(a - shift, 0), min(b - shift, WIDTH)) for k, a, b in own if b > shift and a < shift + WIDTH]))
    symbols, labels = np.zeros((len(texts), WIDTH), np.uint8), np.zeros((len(texts), WIDTH), np.int64)
    for i, (text, spans) in enumerate(texts):
        symbols[i, :len(text)] = tagger.symbols(text)
        for kind, a, b in spans:
            labels[i, a:b] = 2 * kind + 2
            labels[i, a] = 2 * kind + 1
    return symbols, labels


def train(docs: DataFrame, text_col: str = "text", labelled: int = LABELLED, unlabelled: int = UNLABELLED, seed: int = 7) -> tagger.Model | None:
    """The tagger, from at most ``labelled`` + ``unlabelled`` distinct windows of all
    texts (those of the least hash); None if no window has a span."""
    table = saved(labelled_windows(docs, text_col), "pii-windows")
    order = (F.xxhash64("text"), "text")
    with_span, without = table.where(F.size("kinds") > 0), table.where(F.size("kinds") == 0)
    rows = with_span.orderBy(*order).limit(labelled).collect()
    if not rows:
        return None
    rows += without.orderBy(*order).limit(unlabelled).collect()
    return tagger.train(*training_rows([(r["text"], list(zip(r["kinds"], r["starts"], r["ends"]))) for r in rows], seed), KINDS)


# -- search -------------------------------------------------------------------

def window_spans(model: tagger.Model, texts: list[str]) -> list[list[tuple[int, int, int, float, bool]]]:
    """Per text, what its windows hold: (kind, start, end, confidence, cut off)."""
    places = [(i, a) for i, t in enumerate(texts) if t and TRIGGER.search(t) for a in active_windows(t)]
    out: list[list[tuple[int, int, int, float, bool]]] = [[] for _ in texts]
    for at in range(0, len(places), BATCH):
        part = places[at:at + BATCH]
        rows = np.zeros((len(part), WIDTH), np.uint8)
        for k, (i, a) in enumerate(part):
            piece = tagger.symbols(texts[i][a:a + WIDTH])
            rows[k, :len(piece)] = piece
        labels, sure = tagger.decode(model, rows)
        for k in np.flatnonzero(labels.any(1)):
            i, a = part[k]
            own, size = labels[k], min(WIDTH, len(texts[i]) - a)
            x = 0
            while x < size:
                if not own[x]:
                    x += 1
                    continue
                y, inside = x + 1, (own[x] + 1) // 2 * 2
                while y < size and own[y] == inside:
                    y += 1
                cut = (x == 0 and a > 0) or (y == size and a + size < len(texts[i]))
                out[i].append((int(inside) // 2 - 1, a + x, a + y, float(sure[k, x:y].mean()), bool(cut)))
                x = y
    return out


def reconciled(found: list[tuple[int, int, int, float, bool]]) -> list[Found]:
    """Spans without overlap: cut ones joined, then the largest total of confidence
    times length, ties to the later of equal ends."""
    joined: list[list] = []
    for kind, a, b, sure, cut in sorted(found):
        last = joined[-1] if joined else None
        if last and last[0] == kind and a < last[2] and (cut or last[4]):
            weight = last[2] - last[1]
            last[3] = (last[3] * weight + sure * (b - a)) / (weight + b - a)
            last[2], last[4] = max(last[2], b), last[4] or cut
        else:
            joined.append([kind, a, b, sure, cut])
    spans = sorted({(b, a, kind, sure) for kind, a, b, sure, _ in joined})
    ends = [s[0] for s in spans]
    best, take = [0.0], []
    for i, (b, a, _, sure) in enumerate(spans):
        before = bisect_right(ends, a, 0, i)
        with_it = best[before] + sure * (b - a)
        take.append(before if with_it >= best[-1] else None)
        best.append(max(best[-1], with_it))
    out, i = [], len(spans)
    while i:
        if take[i - 1] is None:
            i -= 1
        else:
            b, a, kind, sure = spans[i - 1]
            out.append((kind, a, b, sure))
            i = take[i - 1]
    return out[::-1]


def plausible(kind: int, span: str) -> bool:
    """Whether the characters can be personal data of that kind."""
    digits = NOT_DIGIT.sub("", span)
    if kind == 0:
        halves = re.split(r"@|[\[(]\x20?[aA][tT]\x20?[\])]", span)
        return len(halves) == 2 and any(map(str.isalnum, halves[0])) and bool(re.search(r"\w(?:\.|\W+dot\W+|\x20?\.\x20?)\w", halves[1], re.I))
    if kind == 1:
        groups = re.findall(r"[0-9]+", span)
        return len(groups) == 4 and all(len(g) < 4 and int(g) <= 255 for g in groups)
    if kind == 2:
        return MAX_CARD[0] <= len(digits) <= MAX_CARD[1] and luhn(digits)
    return MAX_PHONE[0] <= len(digits) <= MAX_PHONE[1] and not re.search(r"[A-Za-z]", span)


def all_spans(texts: list[str], model: tagger.Model | None) -> list[list[tuple[int, int, int, float | None]]]:
    """Per text (kind, start, end, confidence), by kind, then start; none for base."""
    out = []
    for text, found in zip(texts, window_spans(model, texts) if model else [[]] * len(texts)):
        spans: list[tuple[int, int, int, float | None]] = [(*s, None) for s in base_spans(text)]
        if found:
            base = sorted((a, b) for _, a, b, _ in spans)
            ends = np.maximum.accumulate(np.array([b for _, b in base] or [0]))
            for kind, a, b, sure in reconciled(found):
                while a < b and text[a].isspace():
                    a += 1
                while a < b and text[b - 1].isspace():
                    b -= 1
                k = int(np.searchsorted(ends, a, side="right"))
                if sure >= MIN_CONFIDENCE and not (k < len(base) and base[k][0] < b) and TRIGGER.search(text, a, b) and plausible(kind, text[a:b]):
                    spans.append((kind, a, b, sure))
            spans.sort(key=lambda s: s[:3])
        out.append(spans)
    return out


def find(docs: DataFrame, model: tagger.Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): an array of (kind, start, end, confidence), by kind, then start;
    the confidence is null for spans of the base patterns."""
    rows = only(docs, id_col, text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "confidence": c} for k, a, b, c in own] for own in all_spans(texts, model)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], [id_col, "spans"])

    return rows.mapInArrow(search, f"{id_col} {rows.schema[id_col].dataType.simpleString()}, "
                                   "spans array<struct<kind:string,start:bigint,end:bigint,confidence:double>>")


def masked(docs: DataFrame, model: tagger.Model | None, text_col: str = "text") -> DataFrame:
    """All rows and columns, each span replaced by its kind in brackets."""
    at = docs.columns.index(text_col)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = columns[at].to_pylist()
            new = []
            for text, spans in zip(texts, all_spans([t or "" for t in texts], model)):
                out, done = [], 0
                for a, b, kind in sorted((a, b, kind) for kind, a, b, _ in spans):
                    if a >= done:
                        out += [text[done:a], f"[{KINDS[kind]}]"]
                    done = max(done, b)
                new.append(text if text is None else "".join(out) + text[done:])
            columns[at] = pa.array(new, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(replace, docs.schema)
