"""Plain versions of the query contracts, one text at a time, to test against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def quality(text):
    text = text or ""
    words = SPACE_WORD.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit),
            n < 20 or 100 * len(hit) > 30 * n)


def secret_spans(text):
    text = text or ""
    out = []
    kinds = (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
             r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", r"AKIA[A-Z0-9]+()", r"[0-9a-f]+()")
    for k, (pattern, least) in enumerate(zip(kinds, (6, 20, 24))):
        for m in re.finditer(pattern, text):
            if len(m[1] if k == 0 else m[0]) >= least:
                out.append((m.start(), k, m.end()))
    names = ("assign", "access", "hex")
    counts = Counter(k for _, k, _ in out)
    joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(out))
    return counts[0], counts[1], counts[2], hashlib.sha256(joined.encode()).hexdigest(), joined


def text_words(text):
    return TEXT_WORD.findall((text or "").translate(LOWER))


def license_base(text):
    words = text_words(text)
    places, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def contamination(text, items, width=10):
    words = text_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = text_words(item)
        windows = {tuple(own[i:i + width]) for i in range(max(1, len(own) - width + 1))} if own else set()
        for w in windows:
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item_id)
    ids = sorted(map(str, found))
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def shingles(text):
    words = SPACE_WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def components(docs):
    """doc_id -> smallest doc_id reachable by links."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    for k, (d, s) in enumerate(sets):
        common = Counter(j for x in s for j in where[x] if j < k)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                a, b = find(d), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def damaged_conversation(rows):
    """Rows (conv_id, turn, role, text) of one conversation, after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def conversation_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
    rows = damaged_conversation(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    # cheapest way to every (rows done, initials as a state of the pattern), row by row
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def better(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, done) in list(table.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in step:
                        better(table, step[state, role[0]], (cost + 2, audit + "I", (*done, f"{role}:")))
        return table

    for (_, role, text), fault in zip(rows, faults):
        after, cut = {}, fault == "truncated"
        for state, (cost, audit, done) in inserted(best).items():
            better(after, state, (cost + 3, audit + "D", done))
            if fault in ("blank", "duplicate"):
                continue
            if (state, role[:1]) in step:
                better(after, step[state, role[:1]], (cost + cut, audit + "K", (*done, f"{role}:{text}")))
            for new in ("user", "assistant"):
                if (state, new[0]) in step:
                    better(after, step[state, new[0]], (cost + 2 + cut, audit + "R", (*done, f"{new}:{text}")))
        best = after
    cost, audit, done = min((way for state, way in inserted(best).items() if state in ("", "a")), key=lambda w: w[:2])
    counts = Counter(faults)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(done).encode()).hexdigest())


def personal_data(text):
    """(n_email, n_ip, n_card, n_phone, base_sha256, base spans joined)."""
    text = text or ""

    def luhn(digits):
        twice = [int(c) * 2 for c in digits[-2::-2]]
        return (sum(int(c) for c in digits[-1::-2]) + sum(x // 10 + x % 10 for x in twice)) % 10 == 0

    def digits(m):
        return [c for c in m[0] if c in "0123456789"]

    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    found = {k: [m.span() for m in re.finditer(p, text) if ok(m)] for k, (p, ok) in tests.items()}
    joined = ",".join(f"{k}:{a}:{b}" for k, own in found.items() for a, b in own)
    return (*map(len, found.values()), hashlib.sha256(joined.encode()).hexdigest(), joined)
