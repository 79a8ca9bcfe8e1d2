"""Quality rules (operator 1): short-circuit cascade, in Spark SQL functions only.

A rule rejects a document by a condition over its text and its measures. On a
sample each rule's work (expected characters and words it goes through, from the
sample's own lengths) and its rejections are estimated; rules are then put in the
order of rejections per unit of work, each judged on the rows the rules before it
left. A document meets them as one CASE expression, so it stops at the first that
rejects it and never pays for the rest. The order decides the work and which rule
is named, never whether a document is kept.

Null text counts as empty (no words). Repeated rows give repeated results; an
empty table gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SAMPLE_ROWS = 5000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"

# Work of a rule, in units of one character copied.
PER_ROW, COPY, REGEX, LAMBDA = 1.0, 1.0, 8.0, 40.0


@dataclass(frozen=True)
class Rule:
    """``reject`` and ``work`` are conditions and costs over text and measures."""

    name: str
    reject: Column
    work: Column


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def standard_rules() -> list[Rule]:
    """The rules beside the base; mild, so that ordinary prose passes all."""
    text, words, chars = F.col("text"), F.col("n_words"), F.col("word_chars")
    size = F.length(text)
    upper, letters = F.regexp_replace(text, r"[^\p{Lu}]+", ""), F.regexp_replace(text, r"[^\p{L}]+", "")
    return [
        Rule("symbols", F.col("n_symbols") * 12 > chars, F.lit(PER_ROW)),
        Rule("word_length", (chars < words * 2) | (chars > words * 25), F.lit(PER_ROW)),
        Rule("lines_repeat", (F.col("n_dup_lines") >= 3) & (F.col("n_dup_lines") * 2 > F.col("n_lines")), F.lit(PER_ROW)),
        Rule("exclamation", _count(text, "!") * 3 > words, size * COPY),
        Rule("few_letters", F.length(letters) * 2 < chars, size * REGEX),
        Rule("capitals", F.length(upper) * 2 > F.length(letters), size * (2 * REGEX)),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words, base_failed.

    n_repeat_words: every window of ``WINDOW`` words is hashed by doubling (1, 2,
    4, 8 words). Only texts with an equal pair sort their windows by hash; the
    places found, in order, each cover the words up to the next place or eight.
    """
    text = F.col("text")
    df = only(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    bare = F.btrim(text, F.lit(SPACES))
    none = F.array().cast("array<bigint>")
    df = df.select(
        "doc_id", "text", F.length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"),
        _count(text, SYMBOLS).cast("bigint").alias("n_symbols"), lines.alias("lines"),
        F.when(bare == "", none).otherwise(F.transform(F.split(bare, SPACE_CLASS + "+"), lambda w: F.xxhash64(w))).alias("h"))
    kept = ["doc_id", "text", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_words"]
    df = df.withColumns({"n_lines": F.size("lines").cast("bigint"), "n_words": F.size("h").cast("bigint"),
                         "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")})
    width = 1
    while width < WINDOW:
        h, step = F.col("h"), width
        df = df.select(*kept, F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step))).alias("h"))
        width *= 2
    # entries past the last whole window hold hashes of shorter ones: cut off
    df = df.select(*kept, F.when(F.col("n_words") > WINDOW, F.slice(
        "h", F.lit(1), F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int"))).otherwise(none).alias("h"))
    again = F.size(F.array_distinct("h")) < F.size("h")
    df = df.select(*kept, F.when(again, F.array_sort(
        F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))).alias("sorted"))
    s = F.col("sorted")
    twice = F.filter(s, lambda e, i: F.coalesce(e["h"] == F.get(s, i - 1)["h"], F.lit(False))
                     | F.coalesce(e["h"] == F.get(s, i + 1)["h"], F.lit(False)))
    df = df.select(*kept, F.sort_array(F.transform(twice, lambda e: e["at"])).alias("at"))
    at = F.col("at")
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x)
    # A filter on the result must not be pushed below here: Catalyst would write
    # all the steps above out inside one another. It stops at a row-dependent expression.
    always = F.monotonically_increasing_id() >= 0
    df = df.select(*kept, F.when(always, F.coalesce(covered, F.lit(0)).cast("bigint")).alias("n_repeat_words"))
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))


def cascade_order(measures: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by rejections per work. Of the rows only the sums of each pattern of
    rejections come back."""
    flags = [F.when(r.reject, 1).otherwise(0).alias(f"r{k}") for k, r in enumerate(rules)]
    work = [r.work.cast("double").alias(f"w{k}") for k, r in enumerate(rules)]
    patterns = measures.select(*flags, *work).groupBy(*[f"r{k}" for k in range(len(rules))]).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"w{k}").alias(f"w{k}") for k in range(len(rules))]).collect()
    left, out = set(range(len(rules))), []
    while left:
        def value(k: int) -> float:
            return sum(p["n"] for p in patterns if p[f"r{k}"]) / (sum(p[f"w{k}"] for p in patterns) or 1.0)

        best = max(left, key=lambda k: (value(k), -k))
        patterns = [p for p in patterns if not p[f"r{best}"]]
        left.remove(best)
        out.append(rules[best])
    return out


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: the measures, kept, and rejected_by (``base``, a rule, or null)."""
    rules = standard_rules() if rules is None else rules
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs if share == 1.0 else docs.sample(share, seed=1)
    first = F.when(F.col("base_failed"), F.lit("base"))
    for rule in cascade_order(measured(sample).where(~F.col("base_failed")), rules):
        first = first.when(rule.reject, F.lit(rule.name))
    return measured(docs).withColumn("rejected_by", first).drop("text").withColumn("kept", F.col("rejected_by").isNull())
