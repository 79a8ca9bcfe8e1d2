"""License scans (operator 4): fuzzy search for short notices.

A notice may differ from its text by up to k edits (one in ``EDIT_EVERY``
characters; notices under ``FUZZY_FROM`` characters must match exactly). Cut into
k + 1 pieces, at least one piece stands unchanged in every such match, so exact
finds of the pieces give all candidate places; the regex library's bounded-error
matching decides there and reports the span and its edits.

Texts are compared as their words (A-Z lower-cased), one space apart. Null text
has no words; repeated rows give repeated results; an empty table gives an empty
result; columns besides the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import text as T
from .common import only

EDIT_EVERY = 10
FUZZY_FROM = 16

# Phrases counted exactly, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices found with errors, with their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache",
    "apache license version 2 0": "apache",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "permission to use copy modify and or distribute this software": "isc",
    "the software is provided as is without warranty of any kind": "mit",
    "this is free and unencumbered software": "unlicense",
    "gnu free documentation license": "gfdl",
    "boost software license": "bsl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "sil open font license": "ofl",
    "academic free license": "afl",
    "microsoft public license": "ms-pl",
    "creative commons zero": "cc0",
}

# Identifiers of a machine-readable notice, which must stand there without errors.
IDENTIFIER = "spdx license identifier "
IDENTIFIED = {
    "mit": "mit", "apache 2 0": "apache", "gpl 2 0": "gpl", "gpl 3 0": "gpl", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl",
    "agpl 3 0": "agpl", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "mpl 2 0": "mpl", "epl 2 0": "epl", "isc": "isc",
    "cc0 1 0": "cc0", "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc", "unlicense": "unlicense",
    "bsl 1 0": "bsl", "ofl 1 1": "ofl", "eupl 1 2": "eupl",
}


class Notice:
    """One notice: its pieces with their places, and the bounded-error pattern."""

    def __init__(self, phrase: str, label: str, exact: bool = False):
        self.phrase, self.label = phrase, label
        self.edits = len(phrase) // EDIT_EVERY if len(phrase) >= FUZZY_FROM and not exact else 0
        cuts = [len(phrase) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.pieces = [(phrase[a:b].encode(), a) for a, b in zip(cuts, cuts[1:])]
        errors = f"{{e<={self.edits}}}" if self.edits else ""
        self.pattern = regex.compile(rf"(?<![^ ])(?:{regex.escape(phrase, special_only=True)}){errors}(?![^ ])", regex.BESTMATCH)

    def windows(self, places: list[int], text: str) -> Iterator[tuple[int, int]]:
        """Stretches, widened to whole words, that hold every match with one of the
        pieces at one of the places."""
        size = len(self.phrase) + 2 * self.edits
        merged: list[list[int]] = []
        for p in sorted(places):
            a, b = max(0, p - self.edits), min(len(text), p + size)
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            yield text.rfind(" ", 0, a) + 1, (text + " ").find(" ", b)

    def matches(self, text: str, places: list[int]) -> list[tuple[int, int, int]]:
        """(start, end, edits) in the text of words."""
        out, left = [], list(self.windows(places, text))
        while left:  # the best match of a stretch, then what lies before and behind it
            a, b = left.pop()
            if m := self.pattern.search(text, a, b):
                out.append((m.start(), m.end(), sum(m.fuzzy_counts)))
                left += [(a, m.start()), (m.end(), b)]
        return sorted(out)


def _spaced(words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """(words of all texts with one byte after each, offsets of the texts in it)."""
    keep = np.zeros(len(words.buf) + 1, bool)
    keep[:-1] = T.LETTER_DIGIT[words.buf]
    size = words.end - words.start
    ends = np.cumsum(size + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = words.buf[keep[:-1]]
    return out, np.concatenate([[0], ends])[words.first]


def _find_all(data: bytes, piece: bytes) -> list[int]:
    out, at = [], data.find(piece)
    while at >= 0:
        out.append(at)
        at = data.find(piece, at + 1)
    return out


def _places(data: bytes, offsets: np.ndarray, notices: list[Notice]) -> dict[int, dict[int, list[int]]]:
    """text -> notice -> byte places in the text where a match could start."""
    out: dict[int, dict[int, list[int]]] = {}
    for k, notice in enumerate(notices):
        for piece, inner in notice.pieces:
            for at in _find_all(data, piece):
                i = int(np.searchsorted(offsets, at, side="right")) - 1
                out.setdefault(i, {}).setdefault(k, []).append(at - int(offsets[i]) - inner)
    return out


OUT = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
       "score double, matches string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE_PHRASES,
         notices: dict[str, str] = NOTICES, identified: dict[str, str] = IDENTIFIED) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels,
    score (best match: 1 - edits / characters) and matches, comma-joined
    label:first word:word past the last:edits of every place found."""
    rows = only(docs, id_col, text_col)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = [(f" {p} ", label) for p, label in base.items()]
        hints = [p.strip().encode() for p, _ in exact]
        own = [Notice(p, label) for p, label in notices.items()] + [Notice(IDENTIFIER + p, label, exact=True) for p, label in identified.items()]
        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(1), lower=True):
                words = T.Words(buf, offsets, T.LETTER_DIGIT)
                spaced, at = _spaced(words)
                data = spaced.tobytes()
                places = _places(data, at, own)
                for hint in hints:
                    for p in _find_all(data, hint):
                        places.setdefault(int(np.searchsorted(at, p, side="right")) - 1, {})
                out = [(n, 0, None, None, "", "", 0.0, "") for n in words.counts.tolist()]
                for i, found in places.items():
                    out[i] = _judge(data[at[i]:at[i + 1]].decode().rstrip(" "), out[i][0], exact, own, found)
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                    [id_col, *(x.split()[0] for x in OUT.split(", "))])

    return rows.mapInArrow(find, f"{id_col} {rows.schema[id_col].dataType.simpleString()}, {OUT}")


def _judge(text: str, n_words: int, exact, notices: list[Notice], places: dict[int, list[int]]):
    """One result row of a text of words in which something may be found."""
    padded = f" {text} "
    starts, base_labels, matches = [], set(), {}
    for phrase, label in exact:
        p = padded.find(phrase)
        while p >= 0:
            first = padded.count(" ", 0, p)
            starts.append(first)
            base_labels.add(label)
            matches[first, first + phrase.count(" ") - 1, label] = (0, 1.0)
            p = padded.find(phrase, p + 1)
    raw = text.encode()
    for k, found in places.items():
        # byte places to characters; a match may start in the middle of one
        chars = [len(raw[:max(0, p)].decode(errors="ignore")) for p in found]
        for a, b, edits in notices[k].matches(text, chars):
            key = (text.count(" ", 0, a), text.count(" ", 0, b) + 1, notices[k].label)
            score = 1 - edits / len(notices[k].phrase)
            if key not in matches or matches[key][1] < score:
                matches[key] = (edits, score)
    # of overlapping notices the ones with the fewest edits stay
    matches = {k: v for k, v in matches.items() if not v[0] or not any(
        a < k[1] and k[0] < b and edits < v[0] for (a, b, _), (edits, _) in matches.items())}
    joined = ",".join(f"{label}:{a}:{b}:{edits}" for (a, b, label), (edits, _) in sorted(matches.items()))
    return (n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
            ",".join(sorted({label for _, _, label in matches})), max([0.0, *(s for _, s in matches.values())]), joined)
