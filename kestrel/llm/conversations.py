"""Conversation structure repair (operator 12): a suffix-shared DAWG.

A conversation is read as a string with one symbol a row, in order of turn (nulls
first), then role, then a hash of the text: ``d`` for a row that must go (blank, or
its role and text stood earlier), else the role's class ``s``, ``u``, ``a`` or ``x``,
in upper case if the text is cut off. Edits turn its roles into ``(s?(ua)+)?``: Keep
0, Rerole 2, Delete 3, Insert 2, and 1 for each cut-off row that stays.

All distinct strings are sorted from their ends, so that equal suffixes stand
together. A node of the automaton is a suffix; it holds, for each of the four grammar
states, the cost to go and the first edit of the best rest. A node is made once and
used by every string that ends so; only the nodes of the last string are held. Two
edits of a state differ in their first letter, so the least letter among the cheapest
edits gives the least audit.

Rows of one conversation may lie in several tasks: rows are counted by
(conversation, turn, role, text hash) first, then range-sorted, and each task writes
one segment for each conversation it has a part of. Only the last step, which gives
the repaired rows or their digest, reads a conversation in one task, as a stream.

Results: a null role or text counts as one space; an empty role has the class ``x``;
rows with a null conversation are one conversation; repeated rows are duplicates; a
conversation without rows costs 0 and has an empty audit; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import only, saved

# Costs of the edits, the grammar (s?(ua)+)? as states (nothing yet,
# after s, after u, after a), and the pairs of initials that may stand together.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
START, AFTER_S, AFTER_U, AFTER_A = range(4)
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # what Insert and Rerole must give
FINAL = (START, AFTER_A)
ROLES = {AFTER_U: "user", AFTER_A: "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
# ---

SPACE = "\\x20\\x09-\\x0D"
BROADCAST_CHARS = 16_000_000

Node = tuple[tuple[float, ...], tuple[str, ...]]  # by state: cost to go, first edit


def end_node() -> Node:
    """After the last row: stop in a final state, else insert."""
    return (0, 2 * INSERT, INSERT, 0), ("", "I", "I", "")


def node(symbol: str, rest: Node) -> Node:
    """The suffix that ``symbol`` and then ``rest`` make."""
    role, extra = symbol.lower(), CUT_OFF * symbol.isupper()
    options = []
    for state in range(4):
        ways = {"D": DELETE + rest[0][state]}
        if symbol != "d":
            if (state, role) in KEPT:
                ways["K"] = extra + rest[0][KEPT[state, role]]
            ways["R"] = REROLE + extra + rest[0][NEXT[state]]
        options.append(ways)
    cost = [min(w.values()) for w in options]
    for _ in range(3):  # inserts lead from state to state before the same row
        cost = [min(c, INSERT + cost[NEXT[s]]) for s, c in enumerate(cost)]
    for state, ways in enumerate(options):
        ways["I"] = INSERT + cost[NEXT[state]]
    return tuple(cost), tuple(min(k for k, c in w.items() if c == cost[s]) for s, w in enumerate(options))


def audits(strings: Iterable[str]) -> Iterator[tuple[int, str]]:
    """(cost, audit) of each string; the strings come in order of their reverse."""
    path, last = [end_node()], ""
    for string in strings:
        back = string[::-1]
        n = next((i for i, (a, b) in enumerate(zip(back, last)) if a != b), min(len(back), len(last)))
        del path[n + 1:]
        for symbol in back[n:]:
            path.append(node(symbol, path[-1]))
        last = back
        state, out, at = START, [], len(back)
        while edit := path[at][1][state]:
            out.append(edit)
            if edit == "K":
                state = KEPT[state, string[len(back) - at].lower()]
            elif edit != "D":
                state = NEXT[state]
            at -= edit != "I"
        yield path[-1][0][START], "".join(out)


def normal_rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text), nulls of the last two as one space."""
    r = only(rows, conv_col, turn_col, role_col, text_col).toDF("conv", "turn", "role", "text")
    return r.select("conv", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))


def _key():
    return F.unhex(F.sha2("text", 256)).alias("key")


def _blank():
    return ~F.col("text").rlike(f"[^{SPACE}]")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of a task: its part of the string and what it
    needs to be joined to the parts beside it."""
    part = TaskContext.get().partitionId()
    out, seg, before = [], None, None
    for batch in batches:
        for conv, turn, role, n, blank, cut, again in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 6, 7))):
            initial = role[:1]
            if seg is None or conv != seg["conv"]:
                if seg is not None:
                    out.append(seg)
                seg = {"conv": conv, "part": part, "first_turn": turn, "first_initial": initial, "least": None, "turns": 0, "text": [],
                       "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
                before = None
            if turn is not None and (before is None or turn != before[0]):
                seg["turns"] += 1
                seg["least"] = turn if seg["least"] is None else seg["least"]
            if before is not None:
                seg["illegal"] += before[1] + initial not in LEGAL_PAIRS
            seg["illegal"] += n - 1
            first = 0 if blank or again else 1
            seg["blank"] += n if blank else 0
            seg["duplicate"] += 0 if blank else n - first
            seg["truncated"] += first if cut else 0
            symbol = initial if initial in ("s", "u", "a") else "x"
            seg["text"].append((symbol.upper() if cut else symbol) * first + "d" * (n - first))
            before = turn, initial
            seg["last_turn"], seg["last_initial"] = before
            if len(out) >= 10_000:
                yield _batch(out, batch.schema)
                out = []
    if seg is not None:
        yield _batch([*out, seg], batch.schema)


_COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal")


def _batch(segments: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    kinds = {"conv": schema.field("conv").type, "part": pa.int32(), "first_turn": schema.field("turn").type,
             "last_turn": schema.field("turn").type, "least": schema.field("turn").type, "first_initial": pa.string(), "last_initial": pa.string(),
             **dict.fromkeys(_COUNTS, pa.int64()), "text": pa.string()}
    rows = [s | {"text": "".join(s["text"])} for s in segments]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in kinds.items()], list(kinds))


def signatures(rows: DataFrame) -> DataFrame:
    """Of :func:`normal_rows`, per conversation: its string and counts."""
    conv_type, turn_type = rows.schema["conv"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    cut = ~F.col("text").rlike(f"[.!?][{SPACE}]*\\z")
    counted = rows.select("conv", "turn", "role", _key(), _blank().alias("blank"), cut.alias("cut")).groupBy(
        "conv", "turn", "role", "key", "blank", "cut").agg(F.count(F.lit(1)).alias("n"))
    counted = saved(counted.select("conv", "turn", "role", "key", "n", "blank", "cut"), "conversation-rows")
    seen = counted.where("NOT blank").groupBy("conv", "role", "key").agg(
        F.min("turn").alias("first"), F.max("turn").alias("last"), F.max(F.col("turn").isNull()).alias("untimed"))
    seen = saved(seen.where("first <> last OR (untimed AND first IS NOT NULL)").select(
        F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("key").alias("_key"),
        F.when(~F.col("untimed"), F.col("first")).alias("first"), "untimed"), "conversation-repeats")
    if seen.count() <= 100_000:  # rows of some 60 bytes
        seen = F.broadcast(seen)
    same = counted["conv"].eqNullSafe(seen["_conv"]) & (counted["role"] == seen["_role"]) & (counted["key"] == seen["_key"])
    again = F.coalesce(F.when(F.col("untimed"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first")), F.lit(False))
    marked = counted.join(seen, same, "left").select(*counted.columns, again.alias("again"))
    order = ("conv", "turn", "role", "key")
    segments = marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _segments, f"conv {conv_type}, part int, first_turn {turn_type}, last_turn {turn_type}, least {turn_type}, first_initial string, "
                   f"last_initial string, {', '.join(f'{c} bigint' for c in _COUNTS)}, text string")
    whole = segments.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("part", "first_turn", "last_turn", "first_initial", "last_initial", "text"))).alias("parts"),
        *(F.sum(c).alias(c) for c in _COUNTS), F.min("least").alias("least"), F.max("last_turn").alias("most"))
    seams = whole.withColumn("seams", F.expr("transform(sequence(1, size(parts)), i -> struct(parts[i - 1] AS a, get(parts, i) AS b))"))
    legal = ", ".join(f"'{p}'" for p in LEGAL_PAIRS)
    return seams.select(
        "conv", F.expr("array_join(transform(parts, p -> p.text), '')").alias("signature"),
        F.expr("CAST(coalesce(CAST(most AS decimal(38,0)) - least + 1 - turns + "
               "size(filter(seams, s -> s.a.last_turn = s.b.first_turn)), 0) AS bigint)").alias("gaps"),
        "blank", "duplicate", "truncated",
        F.expr(f"illegal + size(filter(seams, s -> s.b IS NOT NULL AND concat(s.a.last_initial, s.b.first_initial) "
               f"NOT IN ({legal})))").alias("illegal"))


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(string, cost, audit) of strings sorted by their reverse."""
    held: list[str] = []

    def strings() -> Iterator[str]:
        for batch in batches:
            for s in batch.column(0).to_pylist():
                held.append(s)
                yield s

    found = []
    for pair in audits(strings()):
        found.append(pair)
        if len(found) >= 1_000:
            yield _found(held, found)
            held.clear()
            found = []
    if found:
        yield _found(held, found)


def _found(held: list[str], found: list[tuple[int, str]]) -> pa.RecordBatch:
    cost, audit = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                                      ["_signature", "cost", "audit"])


def plans(rows: DataFrame) -> DataFrame:
    """Of :func:`normal_rows`, per conversation with rows: conv, gaps, blank,
    duplicate, truncated, illegal, cost, audit."""
    own = saved(signatures(rows), "conversation-strings")
    back = F.reverse("signature")
    distinct = own.select("signature").distinct()
    best = saved(distinct.repartitionByRange(back).sortWithinPartitions(back).mapInArrow(
        _repairs, "_signature string, cost bigint, audit string"), "conversation-audits")
    chars = best.agg(F.sum(F.length("_signature") + F.length("audit") + 50).alias("n")).first()["n"] or 0
    if chars <= BROADCAST_CHARS:
        best = F.broadcast(best)
    return own.join(best, own["signature"] == best["_signature"]).drop("signature", "_signature")


def _edited(batches: Iterator[pa.RecordBatch], n_plan: int) -> Iterator[tuple[list | None, list[str]]]:
    """From the plan row and then the rows of each conversation: its plan once, then
    (None, [role, text]) of each repaired row."""
    audit, at, state = "", 0, START

    def inserts() -> Iterator[tuple[None, list[str]]]:
        nonlocal at, state
        while audit[at:at + 1] == "I":
            at, state = at + 1, NEXT[state]
            yield None, [ROLES[state], ""]

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[1] == 0:
                yield from inserts()
                plan = [row[0], *row[6:]]
                audit, at, state = plan[n_plan - 1] or "", 0, START
                yield plan, []
                continue
            yield from inserts()
            edit, role, text = audit[at], row[3], row[5]
            at += 1
            if edit == "K":
                state = KEPT[state, role[:1]]
                yield None, [role, text]
            elif edit == "R":
                state = NEXT[state]
                yield None, [ROLES[state], text]
    yield from inserts()


PLAN = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _streamed(rows: DataFrame, found: DataFrame, ids: DataFrame) -> DataFrame:
    """Every conversation of ``ids`` (conv) as its plan and then its rows, in order."""
    f = found.withColumnRenamed("conv", "_conv")
    whole = ids.join(f, ids["conv"].eqNullSafe(f["_conv"]), "left").select(
        "conv", *(F.coalesce(F.col(c), F.lit("" if c == "audit" else 0)).alias(c) for c in PLAN))
    none = F.lit(None)
    heads = whole.select("conv", F.lit(0).alias("kind"), none.cast(rows.schema["turn"].dataType).alias("turn"), none.cast("string").alias("role"),
                         none.cast("binary").alias("key"), none.cast("string").alias("text"), *PLAN)
    body = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", _key(), F.when(~_blank(), F.col("text")).alias("text"),
                       *(none.cast(found.schema[c].dataType).alias(c) for c in PLAN))
    return heads.unionByName(body).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "key")


def repaired_rows(rows: DataFrame, found: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv, pos, role, text): the repaired rows of :func:`normal_rows` by the
    :func:`plans` found for them, pos from 0."""
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, pos = [], None, 0
        for plan, row in _edited(batches, 1 + len(PLAN)):
            if plan:
                conv, pos = plan[0], 0
                continue
            out.append((conv, pos, *row))
            pos += 1
            if len(out) >= 1_000:
                yield _columns(out, kinds)
                out = []
        if out:
            yield _columns(out, kinds)

    conv_type = rows.schema["conv"].dataType
    kinds = {"conv": to_arrow_type(conv_type), "pos": pa.int64(), "role": pa.string(), "text": pa.string()}
    return _streamed(rows, found, ids).mapInArrow(repair, f"conv {conv_type.simpleString()}, pos bigint, role string, text string")


def repaired_digests(rows: DataFrame, found: DataFrame, ids: DataFrame) -> DataFrame:
    """Every conversation of ``ids`` with its plan and repaired_sha256: of its repaired
    rows as ``role:text``, joined by newlines. Texts are hashed as they stream by."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, plan, sha, empty = [], None, None, True
        for new, row in _edited(batches, 1 + len(PLAN)):
            if new:
                if plan:
                    out.append((*plan, sha.hexdigest()))
                plan, sha, empty = new, hashlib.sha256(), True
                if len(out) >= 1_000:
                    yield _columns(out, kinds)
                    out = []
                continue
            sha.update(("" if empty else "\n").encode() + f"{row[0]}:{row[1]}".encode())
            empty = False
        if plan:
            yield _columns([*out, (*plan, sha.hexdigest())], kinds)

    conv_type = rows.schema["conv"].dataType
    kinds = {"conv": to_arrow_type(conv_type), **dict.fromkeys(PLAN[:-1], pa.int64()), "audit": pa.string(), "repaired_sha256": pa.string()}
    return _streamed(rows, found, ids).mapInArrow(
        digest, f"conv {conv_type.simpleString()}, {', '.join(f'{c} bigint' for c in PLAN[:-1])}, audit string, repaired_sha256 string")


def _columns(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], list(kinds))


def damaged(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """:func:`normal_rows` with planted faults, by crc32 of ``conv:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes
    its role user."""
    rows = normal_rows(convs, conv_col, turn_col, role_col, text_col)
    key = F.concat(F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = rows.withColumn("hit", F.crc32(key.cast("binary")) % 20).where("hit <> 0")
    return hit.select(
        "conv", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")
