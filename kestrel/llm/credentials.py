"""Secret scans (operator 2): assignment-aware lexing.

Besides three token patterns, a small lexer reads ``name = literal`` pairs in the
syntaxes of source code and configuration (``=``, ``:=``, ``=>``, ``:``; names in
subscripts and with type annotations; quoted literals joined by ``+``; bare values
up to white space, comma or semicolon; names as right sides). Names bound to
literals are constants, and a later ``target = constant`` hands the constant's
literals on. A literal is reported when the names it reaches and its own shape
score at least ``THRESHOLD`` together; spaces and lengths of 6 and 7 count only for
quoted literals under a name of weight 1.

Spans are code points, end exclusive. Null text is empty; repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored
by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as T
from .common import only

# Fixed values of the base patterns.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_HINTS = ("passw", "secret", "token", "api")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "literal")

# Name parts that make a target sensitive, with their weight.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.8, "apikey": 1.0,
             "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "signing": 0.6}
SENSITIVE_PAIRS = {("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0,
                   ("client", "secret"): 1.0, ("encryption", "key"): 1.0}
PLACEHOLDERS = {"changeme", "example", "password", "placeholder", "undefined", "redacted", "required", "optional",
                "string", "number", "object", "boolean", "default"}
THRESHOLD = 1.5

_QUOTED = r"(?:[bBrRuUfFL]{1,2}|@)?(?:\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`)"
_VALUE = rf"{_QUOTED}|[^\s,;\"'`(\[{{<A-Za-z0-9+/_.=-]*[A-Za-z0-9+/_.=-]+"
_VALUES = rf"((?:{_VALUE})(?:[ \t]*\+[ \t]*(?:{_VALUE}))*)"
_WORD = r"[A-Za-z_][A-Za-z0-9_.-]*+"
_CLOSE = r"(?:[\"'`]?[ \t]*\]|\[\d*\]|[\"'`])?"  # of a quoted name, a subscript or an array
_PAIR = re.compile(rf"({_WORD}){_CLOSE}[ \t]*(?::=|=>|=|:)[ \t]*{_VALUES}")
_TYPE = r"[&*]*(?:'\w+[ \t]+)?(?:mut[ \t]+)?([A-Za-z_][\w.]*)(?:[\[<(][^\n=;\"]{0,80}[\]>)])?[?!]?(?:\[\])*"
_TYPED = re.compile(rf"(?:({_WORD}){_CLOSE}[?!]?[ \t]*:|\b(?:var|const)[ \t]+({_WORD})[ \t])[ \t]*"
                    rf"({_TYPE}(?:[ \t]*\|[ \t]*{_TYPE.replace('([A-Z', '(?:[A-Z')})*)[ \t]*=(?![=>])[ \t]*{_VALUES}")
_TYPE_NAME = re.compile(r"[A-Za-z_.]+\d{0,3}")
_RUN = re.compile(_WORD)
_PART = re.compile(_VALUE)
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*")
# The rest of a bare value, up to the next one of a query string or a closing tag;
# what makes a name an expression instead; references to values kept elsewhere.
_REST = re.compile(r"(?:(?!&[A-Za-z_][\w.-]*=|</)[^\s,;])+")
_CODE = re.compile(r"[(\[{]|(?<=-)>|::|\?\.|!\(")
_REFERENCE = re.compile(r"\$[A-Za-z_]\w*\Z|\$[{(]|%\(|\{\{|%[A-Za-z_]\w*%\Z")
_LINE_START = re.compile(r"[ \t]*(?:(?:export|set|ENV|-)[ \t]+)?\Z")
_CLOSERS = "\"'`)]}>"
_SUBWORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

Span = tuple[int, int]


def name_score(name: str) -> float:
    """0 to 1: how likely a name's values are secrets."""
    parts = [p.lower() for p in _SUBWORD.findall(name)]
    return max([0.0, *(SENSITIVE.get(p, 0.0) for p in parts),
                *(SENSITIVE_PAIRS.get(pair, 0.0) for pair in zip(parts, parts[1:]))])


def literal_score(literal: str, full: bool = False) -> float:
    """0 to 1: how random a literal looks, by length, entropy and kinds of characters.
    ``full``: quoted and under a fully sensitive name, so short ones and ones with
    spaces count too."""
    if len(literal) < (6 if full else 8) or (" " in literal and not full) or literal.strip().lower() in PLACEHOLDERS | {""}:
        return 0.0
    n = len(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(any(test(c) for c in literal) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.15 * entropy + 0.15 * kinds + (0.1 if n >= 16 else 0.0))


def _bare_end(text: str, name: int, a: int, b: int) -> int:
    """Where the bare value that starts at ``a`` and is lexed up to ``b`` ends."""
    rest = _REST.match(text, b)
    if not rest or (_NAME.fullmatch(text, a, b) and _CODE.match(text, b)):
        return b
    end = rest.end()
    line = text[text.rfind("\n", 0, name) + 1:name]
    if text[end:end + 1] not in ("", "\n", "\r") or not _LINE_START.match(line):
        while end > b and text[end - 1] in _CLOSERS:
            end -= 1
    return end if literal_score(text[a:end]) >= literal_score(text[a:b]) else b


def _each(pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """Matches from left to right. They start with a word, which is tried at its first
    letter only: from a later one it would end at the same place."""
    word = _RUN.search(text)
    while word:
        m = pattern.match(text, word.start())
        if m:
            yield m
        word = _RUN.search(text, m.end() if m else word.end())


def _pairs(text: str) -> list[tuple[int, int, int, tuple[str, ...]]]:
    """(value start, value end, name start, names) of the pairs, in order of the text.
    Where ``x: y = literal`` may be a type as well as a name, both names count."""
    typed, types = [], set()
    if "=" in text:
        for m in _each(_TYPED, text):
            typed.append((*m.span(5), m.start(), (m[1] or m[2], m[4])))
            if _TYPE_NAME.fullmatch(m[4]):
                types.add(m.start(4))
    plain = [(*m.span(2), m.start(), (m[1],)) for m in _each(_PAIR, text) if m.start(2) not in types]
    return sorted(typed + plain)


def literal_spans(text: str) -> list[Span]:
    """Literals whose names, also by propagation, and shape make them secrets."""
    latest: dict[str, int] = {}     # name -> the pair that bound it last
    handed: list[set[int]] = []     # pair -> the pairs whose constants it takes over
    scores: list[float] = []
    literals: list[tuple[int, Span]] = []
    quoted: set[Span] = set()
    for k, (start, end, at, names) in enumerate(_pairs(text)):
        taken: set[int] = set()
        for part in _PART.finditer(text, start, end):
            a, b = part.span()
            if part[0][-1] in "\"'`":
                a = min(k for k in (text.find(q, a, b) for q in "\"'`") if k >= 0)
                literals.append((k, (a + 1, b - 1)))
                quoted.add((a + 1, b - 1))
            elif part[0] in latest and _NAME.fullmatch(part[0]):
                taken.add(latest[part[0]])
            else:
                b = _bare_end(text, at, a, b)
                if not _REFERENCE.match(text[a:b]):
                    literals.append((k, (a, b)))
        latest.update(dict.fromkeys(names, k))
        handed.append(taken)
        scores.append(max(map(name_score, names)))
    # a pair's literals reach the names of every pair that takes them over, which
    # comes later in the text
    for k in range(len(handed) - 1, -1, -1):
        for j in handed[k]:
            scores[j] = max(scores[j], scores[k])
    best: dict[Span, float] = {}
    for k, span in literals:
        if scores[k]:
            best[span] = max(best.get(span, 0.0), scores[k])
    return sorted(s for s, score in best.items()
                  if score + literal_score(text[s[0]:s[1]], score >= 1 and s in quoted) >= THRESHOLD)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the three token patterns, by start, then kind."""
    low = text.lower()
    out = []
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def all_spans(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """(base spans, base and literal spans): literals inside a base span are left out."""
    base = base_spans(text)
    found = list(base)
    if "=" in text or ":" in text:
        found += [(a, "literal", b) for a, b in literal_spans(text) if not any(x <= a and b <= y for x, _, y in base)]
    return base, sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256, spans, n_literal."""
    rows = only(docs, id_col, text_col)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base, spans = all_spans(text or "")
                kinds = Counter(s[1] for s in spans)
                out.append((*(kinds[k] for k in KINDS[:3]), hashlib.sha256(_joined(base).encode()).hexdigest(),
                            _joined(spans), kinds["literal"]))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])

    return rows.mapInArrow(T.tidy(find), f"{id_col} {rows.schema[id_col].dataType.simpleString()}, n_assign bigint, n_access bigint, "
                                 "n_hex bigint, base_sha256 string, spans string, n_literal bigint")


def redacted(text: str, mark: str = "[REDACTED]") -> str:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    out, at = [], 0
    for a, _, b in all_spans(text)[1]:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows and columns, with secrets replaced in the text; ``length_col``, if
    given, holds its new length in code points where the text has changed."""
    names = docs.columns
    at, size = names.index(text_col), names.index(length_col) if length_col else None

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            before = columns[at].to_pylist()
            after = [t if t is None else redacted(t) for t in before]
            columns[at] = pa.array(after, columns[at].type)
            if size is not None:
                old = columns[size].to_pylist()
                columns[size] = pa.array([n if a == b else len(a) for n, a, b in zip(old, after, before)], columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(T.tidy(replace), docs.schema)
