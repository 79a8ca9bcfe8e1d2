"""URL filters (operator 8): rules, then a Bloom filter cascade, in Spark SQL
functions only.

The cascade holds a set of listed keys within a known universe of keys. Level 1 is
a Bloom filter of the listed keys; level 2 one of the unlisted keys that pass level
1 by mistake; level 3 one of the listed keys that pass level 2; and so on until no
key is mistaken. A key of the universe is listed exactly if the first level that
refuses it is an even one (or none does and the last is odd). Every key of the
table is in the universe, so the answer is exact, and rows need no join.

A level is one array of 64-bit words, read by the tasks as a scalar subquery, of at
most ``max_bytes``. Where a level would be larger, the universe is cut in two by the
hash of the key, and each half has a cascade of its own, cut again if need be. Rows
are then written by shard, judged shard by shard (one shard's levels travel at a
time) and written; no row is joined or shuffled, so a hot host costs nothing extra.

A null url, or one without "://", has an empty host and path; the empty host is
never listed. Repeated rows give repeated results; an empty table gives an empty
result; columns besides page_id and url are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import only, saved

BITS_PER_KEY = 8
HASHES = 4
MAX_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host in lower case, path) of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """page_id, host, path, rule and rule_verdict (null where no rule fits)."""
    host, path = split_url(F.col("url"))
    df = only(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rule = verdict = None
    for r in sorted(rules, key=lambda r: -len(r.text)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = (F if rule is None else rule).when(fits, F.lit(r.text))
        verdict = (F if verdict is None else verdict).when(fits, F.lit(r.verdict))
    none = F.lit(None).cast("string")
    return df.withColumns({"rule": none if rule is None else rule, "rule_verdict": none if verdict is None else verdict})


def _bit(key: Column, level: int, k: int, size: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(size).cast("bigint"))


@dataclass(frozen=True)
class Level:
    number: int
    size: int  # bits
    words: DataFrame  # one row, one array

    def passes(self, key: Column) -> Column:
        out = F.lit(True)
        words = self.words.scalar()
        for k in range(HASHES):
            bit = _bit(key, self.number, k, self.size)
            word = F.get(words, F.shiftright(bit, 6).cast("int"))
            out = out & (F.call_function("shiftrightunsigned", word, F.pmod(bit, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return out


def _level(keys: DataFrame, number: int, size: int) -> Level:
    spark = keys.sparkSession
    bits = keys.select(F.explode(F.array(*[_bit(F.col("key"), number, k, size) for k in range(HASHES)])).alias("bit"))
    one = F.lit(1).cast("bigint")
    words = bits.groupBy(F.shiftright("bit", 6).alias("id")).agg(
        F.bit_or(F.call_function("shiftleft", one, F.pmod("bit", F.lit(64)).cast("int"))).alias("w"))
    dense = spark.range(size // 64).join(words, "id", "left").select("id", F.coalesce("w", F.lit(0).cast("bigint")).alias("w"))
    # one row of at most MAX_BYTES
    row = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "w"))), lambda x: x["w"]).alias("words"))
    return Level(number, size, saved(row, "bloom-level"))


@dataclass(frozen=True)
class Shard:
    """The keys whose hash leaves ``rest`` modulo ``parts``."""

    parts: int = 1
    rest: int = 0

    def holds(self, code: Column) -> Column:
        return F.lit(True) if self.parts == 1 else F.pmod(code, F.lit(self.parts)) == self.rest

    def halves(self) -> tuple[Shard, Shard]:
        return Shard(2 * self.parts, self.rest), Shard(2 * self.parts, self.rest + self.parts)


def _code(key: Column) -> Column:
    """Hash that deals keys to shards (levels hash with numbers from 1)."""
    return F.xxhash64(key, F.lit(0))


class TooLarge(Exception):
    """A level would be larger than may travel to the tasks."""


def build_cascade(keys: DataFrame, max_bytes: int = MAX_BYTES) -> list[Level]:
    """Levels for a universe ``keys`` (key, listed), each key once."""
    levels: list[Level] = []
    inside, outside = keys.where("listed").select("key"), keys.where("NOT listed").select("key")
    while (n := inside.count()):
        size = -(-n * BITS_PER_KEY // 64) * 64
        if size // 8 > max(8, max_bytes):
            raise TooLarge(f"{size // 8} bytes")
        levels.append(_level(inside, len(levels) + 1, size))
        inside, outside = saved(outside.where(levels[-1].passes(F.col("key"))), "bloom-keys"), inside
    return levels


def cascades(keys: DataFrame, max_bytes: int = MAX_BYTES, shard: Shard = Shard()) -> Iterator[tuple[Shard, list[Level]]]:
    """The shards of a universe, by halving, with the cascade of each."""
    try:
        yield shard, build_cascade(keys, max_bytes)
    except TooLarge:
        for half in shard.halves():
            own = saved(keys.where(half.holds(_code(F.col("key")))), "url-shard")
            yield from cascades(own, max_bytes, half)


def is_listed(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    out = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        out = F.when(level.passes(key), out).otherwise(F.lit(level.number % 2 == 0))
    return out


def with_listed(df: DataFrame, keys: DataFrame, column: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` with ``listed``: whether its key column is listed in ``keys``."""
    key = F.col(column)

    def judged(rows: DataFrame, levels: list[Level]) -> DataFrame:
        return rows.withColumn("listed", F.when(key == "", F.lit(False)).otherwise(is_listed(levels, key)))

    shards = cascades(keys, max_bytes)
    shard, levels = next(shards)
    if shard.parts == 1:
        return judged(df, levels)
    parts, out = shard.parts, None
    rows = _by_shard(df, key, parts)
    while shard is not None:
        folders = min(parts, shard.parts)
        own = rows.where((F.pmod("_folder", F.lit(folders)) == shard.rest % folders) & shard.holds(F.col("_shard")))
        part = saved(judged(own.drop("_folder", "_shard"), levels), "url-judged")
        out = part if out is None else out.unionByName(part)
        shard, levels = next(shards, (None, []))
    return out


def _by_shard(df: DataFrame, key: Column, parts: int) -> DataFrame:
    """``df`` written in a ``_folder`` for each remainder of its key's hash modulo
    ``parts``, with the hash itself in ``_shard`` for shards cut finer than that."""
    path = scratch_path(df.sparkSession, "url-rows")
    rows = df.withColumn("_shard", _code(key))
    rows.withColumn("_folder", F.pmod("_shard", F.lit(parts))).write.partitionBy("_folder").parquet(path)
    return df.sparkSession.read.parquet(path)


def judge(pages: DataFrame, rules: list[UrlRule], max_bytes: int = MAX_BYTES) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict. Where no rule fits, the host's
    reputation decides: a host of whose pages the rules block more than they allow
    is listed, and its other pages are blocked too."""
    df = ruled(pages, rules)
    score = F.when(F.col("rule_verdict") == "block", 1).when(F.col("rule_verdict") == "allow", -1).otherwise(0)
    keys = saved(df.where("host <> ''").groupBy(F.col("host").alias("key")).agg((F.sum(score) > 0).alias("listed")), "url-keys")
    out = with_listed(df, keys, "host", max_bytes)
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "rule_verdict", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
