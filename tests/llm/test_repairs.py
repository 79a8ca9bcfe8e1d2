"""Secret and license scans on texts that must not be slow or lose a span."""

import random
import time

import pytest

from kestrel.llm import credentials, licenses


@pytest.mark.parametrize("text", [
    "x = 1 " + "a" * 1_000_000, "k=" + "a1" * 500_000, "1" * 1_000_000 + " = 2", "-a" * 500_000 + "=",
    "a: " + "b" * 500_000 + ": " + "c|" * 200_000, "x0 = 'Zk93jd82kLq0'\n" + "".join(f"x{i + 1} = x{i} + x{i}\n" for i in range(60)),
    "x0 = 'Zk93jd82kLq0'\n" + "".join(f"x{i + 1} = x{i} + 'lit{i}'\n" for i in range(20_000)),
])
def test_secret_lexer_takes_linear_time(text):
    start = time.process_time()
    credentials.literal_spans(text)
    credentials.redacted(text)
    assert time.process_time() - start < 8


def test_constants_reach_a_sensitive_name_through_a_long_chain():
    text = "x0 = 'Zk93jd82kLq0'\n" + "".join(f"x{i + 1} = x{i} + x{i}\n" for i in range(60)) + "db_password = x60\n"
    assert [text[a:b] for a, b in credentials.literal_spans(text)] == ["Zk93jd82kLq0"]
    # bound again before it is used: the first literal isn't handed on
    text = "x = 'Zk93jd82kLq0'\nx = 'Qw82mm10aPx7'\npassword = x\n"
    assert [text[a:b] for a, b in credentials.literal_spans(text)] == ["Qw82mm10aPx7"]


def found(text):
    words = text.encode()
    out = []
    for n in [licenses.Notice(p, label) for p, label in licenses.NOTICES.items()]:
        places = [at - inner for piece, inner in n.pieces for at in licenses._find_all(words, piece)]
        out += [(n.phrase, *m) for m in n.matches(text, places)]
    return out


def test_a_worse_match_before_a_better_one_is_kept():
    text = "licensed under the apach license licensed under the apache license"
    got = [m[1:] for m in found(text) if m[0] == "licensed under the apache license"]
    assert got == [(0, 32, 1), (33, 66, 0)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_notices_with_errors_against_a_plain_search():
    rng = random.Random(8)
    for _ in range(40):
        phrase = rng.choice(list(licenses.NOTICES))
        edits = licenses.Notice(phrase, "").edits
        changed = list(phrase)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(1, len(changed) - 1)
            changed[at:at + 1] = rng.choice([[], ["q"], [changed[at], "z"]])
        planted = " ".join("".join(changed).split())
        filler = [rng.choice(["lorem", "ipsum", "dolor", "the", "of"]) for _ in range(8)]
        text = " ".join([*filler[:4], planted, *filler[4:]])
        words = text.split(" ")
        starts = [sum(len(w) + 1 for w in words[:i]) for i in range(len(words) + 1)]
        plain = {(starts[i], starts[j] - 1) for i in range(len(words)) for j in range(i + 1, len(words) + 1)
                 if distance(text[starts[i]:starts[j] - 1], phrase) <= edits}
        got = {m[1:3] for m in found(text) if m[0] == phrase}
        assert bool(got) == bool(plain) and got <= plain


def test_identifiers_are_exact(spark):
    docs = spark.createDataFrame([(1, "// SPDX-License-Identifier: MPL-2.0"), (2, "SPDX-License-Identifier: MIX")], "doc_id int, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert got == {1: "mpl", 2: ""}
