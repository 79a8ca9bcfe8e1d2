"""Byte-level BPE inside Spark tasks, through the tokenizers library.

``ChunkEncoder`` cuts a text where the byte-level splitter surely starts a new
piece and never looks back: before white space that follows a character which
can't be white space, and between letters, digits and punctuation of ASCII. So
the ids of a text are the ids of its chunks, one after the other (``tests/llm``
holds this against the library's own encoding of whole texts). Equal chunks of a
slice are found with numpy, by hash and then byte for byte; each distinct chunk
is encoded once, and a bounded memo carries results from slice to slice.

``PrefixCounter`` gives the token count of every prefix of a chunk by dynamic
programming over its pieces (see ``token_counts``).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

from . import text as T

MEMO_ENTRIES = 200_000  # of each of a memo's two generations

_WS = ~T.NON_SPACE
# Bytes after which a white space byte may start a chunk: printable ASCII; a byte
# of a longer character too, if that character can't be one of Unicode's spaces.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_WIDE_LEAD = np.zeros(256, bool)  # lead bytes of the spaces beyond two bytes
_WIDE_LEAD[0xE1:0xE4] = True
_LATIN1 = np.zeros(256, bool)  # second bytes of the letters U+00C0 to U+00FF
_LATIN1[0x80:0xC0] = True
_LATIN1[[0x97, 0xB7]] = False

_WORD = re.compile("\x20?(?:[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+|[0-9]+)")


def byte_classes(specials: list[str]) -> np.ndarray:
    """1 for ASCII letters, 2 for digits, 3 for punctuation, 0 for the rest: the
    apostrophe (contractions) and what could stand inside a special token."""
    out = np.zeros(256, np.uint8)
    out[0x21:0x7F] = 3
    out[0x30:0x3A] = 2
    out[0x41:0x5B] = out[0x61:0x7B] = 1
    out[0x27] = 0
    for b in "".join(specials).encode():
        if _WS[b]:
            raise ValueError("a special token with white space can't be kept in one chunk")
        if out[b] != 1:
            out[b] = 0
    return out


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes, in order, for the characters from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def chunk_spans(buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first chunk of each text) of the chunks of a slice."""
    n = len(buf)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        own = classes[buf]
        latin = np.flatnonzero(buf[:-1] == 0xC3) + 1
        left = own.copy()  # the class of the character that ends at a byte
        left[latin[_LATIN1[buf[latin]]]] = 1
        cut[1:n] = (own[1:] != left[:-1]) & (own[1:] > 0) & (left[:-1] > 0)
        at = np.flatnonzero(_WS[buf[1:]]) + 1
        before = buf[at - 1]
        two, three = buf[np.maximum(at - 2, 0)], buf[np.maximum(at - 3, 0)]
        cut[at] = _PLAIN[before] | ((before >= 0x80) & (two != 0xC2) & ~_WIDE_LEAD[three])
    cut[offsets] = True
    cut[n] = False
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n) if len(start) else start
    return start, end, np.searchsorted(start, offsets)


def _distinct(buf, start, end) -> tuple[np.ndarray, np.ndarray]:
    """(index of one chunk of each distinct kind, kind of every chunk)."""
    size = end - start
    _, rep, kind = np.unique(T.span_hashes(buf, start, end), return_index=True, return_inverse=True)
    chosen = rep[kind]
    if (size == size[chosen]).all():
        shift = np.repeat(start[chosen] - start, size)
        if np.array_equal(buf[np.arange(len(buf)) + shift], buf):
            return rep, kind
    ids = np.arange(len(start))  # a hash collision: every chunk is its own kind
    return ids, ids


class ChunkEncoder:
    """Ids of whole texts under one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model, self.pre = self.tok.model, self.tok.pre_tokenizer
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.classes = byte_classes(self.specials)
        self.alphabet = byte_alphabet()
        self.chunks, self.older = {}, {}  # the newer and the older generation of the memo

    def _piece(self, piece: str) -> bytes:
        return np.array([t.id for t in self.model.tokenize(piece)], self.dtype).tobytes()

    def pieces(self, chunk: bytes, text: str) -> list[str]:
        """Pieces in the byte-level alphabet."""
        if _WORD.fullmatch(text):
            return [chunk.decode("latin-1").translate(self.alphabet)]
        return [p for p, _ in self.pre.pre_tokenize_str(text)]

    def _chunk(self, chunk: bytes):
        text = chunk.decode()
        for s in self.specials:
            if s in text:
                return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        return b"".join([self._piece(p) for p in self.pieces(chunk, text)])

    def lookup(self, keys: list[bytes]) -> list:
        """Value of each chunk, from the memo or made now (in sorted order)."""
        out = list(map(self.chunks.get, keys))
        if len(self.chunks) >= MEMO_ENTRIES:
            self.chunks, self.older = {}, self.chunks
        for i in sorted((i for i, v in enumerate(out) if v is None), key=keys.__getitem__):
            known = self.older.get(keys[i])
            out[i] = self.chunks[keys[i]] = self._chunk(keys[i]) if known is None else known
        return out

    def distinct_chunks(self, buf, offsets):
        """(start, first chunk of each text, kind of each chunk, value of each kind)."""
        start, end, first = chunk_spans(buf, offsets, self.classes)
        if not len(start):
            return start, first, start, []
        rep, kind = _distinct(buf, start, end)
        raw = buf.tobytes()
        return start, first, kind, self.lookup([raw[s:e] for s, e in zip(start[rep].tolist(), end[rep].tolist())])

    def encode(self, column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, past the last, ids of those texts in a row, id count of each)."""
        for a, b, buf, offsets in T.slices(column, lower=False):
            _, first, kind, values = self.distinct_chunks(buf, offsets)
            size = np.array([len(v) for v in values], np.int64) // self.dtype.itemsize
            flat = np.frombuffer(b"".join(values), self.dtype)
            n = size[kind] if len(kind) else np.empty(0, np.int64)
            ends = np.concatenate([[0], np.cumsum(n)])
            begin = np.cumsum(size) - size
            ids = flat[np.arange(ends[-1]) + np.repeat(begin[kind] - ends[:-1], n)] if ends[-1] else flat[:0]
            yield a, b, ids, np.diff(ends[first])


class PrefixCounter(ChunkEncoder):
    """Token counts of every prefix: a chunk's value is an int32 array, entry i
    the number of tokens of its first i bytes encoded as a text of their own
    (meant for places between characters)."""

    def __init__(self, path: str):
        super().__init__(path)
        added = set(self.specials)
        self.vocab = {t for t in self.tok.get_vocab() if t not in added}
        self.longest = max(map(len, self.vocab))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.run, self.last, self.count = "", [""], [0]

    def _joins(self, left: str, right: str) -> bool:
        """Whether the two tokens stay as they are side by side (left '' = alone)."""
        got = [t.value for t in self.model.tokenize(left + right)] == [t for t in (left, right) if t]
        if len(self.pairs) >= 2 * MEMO_ENTRIES:
            self.pairs.clear()
        self.pairs[left, right] = got
        return got

    def _piece(self, piece: str) -> np.ndarray:
        """Prefix counts of one piece, in which a character stands for a byte.

        The last token of a prefix is the one token ending there that stays whole
        beside the last token of what precedes it. Entries are kept for the piece
        before, so that a common prefix isn't computed again.
        """
        last, count, vocab, known = self.last, self.count, self.vocab, self.pairs
        same = len(os.path.commonprefix((self.run, piece))) + 1
        del last[same:], count[same:]
        self.run = piece
        for i in range(same, len(piece) + 1):
            for j in range(max(0, i - self.longest), i):
                if (token := piece[j:i]) in vocab:
                    left = last[j]
                    joins = known.get((left, token))
                    if joins is None:
                        joins = self._joins(left, token)
                    if joins:
                        last.append(token)
                        count.append(count[j] + 1)
                        break
            else:
                raise ValueError(f"no token ends at byte {i} of {piece!r}")
        return np.array(count, np.int32)

    def _plain(self, text: str) -> np.ndarray:
        """Prefix counts of a text without special tokens."""
        parts, base, before = [np.zeros(1, np.int32)], 0, None
        for piece, (a, b) in self.pre.pre_tokenize_str(text):
            own = self._piece(piece)
            values = own[1:] + np.int32(base)
            word = text[a:b]
            if before is not None and before[1].isspace() and word[0].isspace():
                # cut after this character, all the white space is one piece
                run = before[0] + piece[:len(word[0].encode())]
                values[len(word[0].encode()) - 1] = before[2] + self._piece(run)[-1]
            if len(word) == 3 and word in ("'re", "'ve", "'ll"):
                values[1] = base + 2  # an apostrophe and one letter are two pieces
            parts.append(values)
            before = (piece, word, base)
            base += int(own[-1])
        return np.concatenate(parts)

    def _chunk(self, chunk: bytes) -> np.ndarray:
        text = chunk.decode()
        if _WORD.fullmatch(text):
            return self._piece(chunk.decode("latin-1").translate(self.alphabet))
        if not any(s in text for s in self.specials):
            return self._plain(text)
        out, segment = [np.zeros(1, np.int32)], ""
        base = i = 0
        while i < len(text):
            special = max((s for s in self.specials if text.startswith(s, i)), key=len, default="")
            if not special:
                segment += text[i]
                i += 1
                continue
            counts = self._plain(segment)
            out.append(counts[1:] + np.int32(base))
            inside = [n for j in range(1, len(special))
                      for n in [len(self.tok.encode(segment + special[:j], add_special_tokens=False).ids)]
                      * len(special[j - 1].encode())]
            inside += [int(counts[-1]) + 1] * len(special[-1].encode())
            out.append(np.array(inside, np.int32) + np.int32(base))
            base += int(counts[-1]) + 1
            segment, i = "", i + len(special)
        out.append(self._plain(segment)[1:] + np.int32(base))
        return np.concatenate(out)

    def prefix_counts(self, text: str) -> np.ndarray:
        """Entry i: tokens of the first i bytes of the text."""
        out, base = [np.zeros(1, np.int32)], 0
        for _, _, buf, offsets in T.slices(_one(text), lower=False):
            _, _, kind, values = self.distinct_chunks(buf, offsets)
            for k in kind:
                out.append(values[k][1:] + np.int32(base))
                base += int(values[k][-1])
        return np.concatenate(out)


def _one(text: str):
    import pyarrow as pa

    return pa.array([text], pa.large_string())


_made: dict[tuple[type, str], ChunkEncoder] = {}


def shared(kind: type, path: str) -> ChunkEncoder:
    """One encoder of a kind and file per Python worker."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]
