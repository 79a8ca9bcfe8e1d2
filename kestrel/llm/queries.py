"""Registered queries of this package, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import load_table
from . import conversations, credentials, decontaminate, jaccard, langid, licenses, packing, pii, quality, token_counts, token_files, urls, whitening

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
SEQUENCE_LENGTH = 2048
FILE_END_ID = 2
PACK_END_ID = 1


URL_RULES = [urls.UrlRule("allow", "org", "/"), urls.UrlRule("block", "example.org", "/es/"),
             urls.UrlRule("block", "example.org", "/en/1"), urls.UrlRule("allow", "com", "/fr/"),
             urls.UrlRule("block", "com", "/de/")]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(load_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(load_table(spark, sf_dir, "documents"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(load_table(spark, sf_dir, "documents"), path, TOKENIZER, FILE_END_ID)
    return token_files.read_documents(spark, path)


@query
def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load_table(spark, sf_dir, "documents"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(load_table(spark, sf_dir, "documents"))


def held_out(docs: DataFrame) -> Column:
    """Rows kept out of training. A row without doc_id is kept out too."""
    return F.coalesce(F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def language_model(docs: DataFrame) -> langid.Model:
    return langid.train(langid.training_sample(docs, ~held_out(docs)))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    found = langid.predict(docs, language_model(docs))
    return found.select("doc_id", held_out(found).alias("held_out"), "lang_pred", "score")


@query
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(load_table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load_table(spark, sf_dir, "documents"), TOKENIZER, TOKEN_LIMIT)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load_table(spark, sf_dir, "documents"), TOKENIZER, PACK_END_ID, SEQUENCE_LENGTH)


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(load_table(spark, sf_dir, "embeddings"), k=16, scale=64.0, offset=1_000_000)


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = load_table(spark, sf_dir, "conversations")
    rows = conversations.damaged(convs)
    found = conversations.plans(rows)
    ids = convs.select(convs["conv_id"].alias("conv")).distinct()
    return conversations.repaired_digests(rows, found, ids).withColumnRenamed("conv", "conv_id")


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    base = F.filter("spans", lambda s: s["confidence"].isNull())

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        (F.size("spans") - F.size(base)).cast("bigint").alias("n_added"))


ORACLES["op1_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         row_number() OVER () AS r
  FROM d
), places AS (
  SELECT r, unnest(words) AS word, unnest(range(0, len(words))) AS i FROM w
), windows AS (
  SELECT r, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
                         lead(word, 4) OVER o, lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o) AS win,
         lead(word, 7) OVER o IS NOT NULL AS whole
  FROM places WINDOW o AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows WHERE whole) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(8) AS t(k) GROUP BY r
), m AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaim,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_upper
  FROM w LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 12 > word_chars OR word_chars < n_words * 2 OR word_chars > n_words * 25
            OR (n_dup_lines >= 3 AND n_dup_lines * 2 > n_lines) OR n_exclaim * 3 > n_words
            OR n_letters * 2 < word_chars OR n_upper * 2 > n_letters) AS kept
FROM b
"""

ORACLES["op8_url_filters"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), r AS (
  SELECT p.page_id, p.host, p.path,
         (SELECT arg_max(s.host || s.path, length(s.host || s.path)) FROM rules s
          WHERE (p.host = s.host OR ends_with(p.host, '.' || s.host)) AND starts_with(p.path, s.path)) AS rule,
         (SELECT arg_max(s.verdict, length(s.host || s.path)) FROM rules s
          WHERE (p.host = s.host OR ends_with(p.host, '.' || s.host)) AND starts_with(p.path, s.path)) AS rv
  FROM p
), listed AS (
  SELECT host FROM r WHERE host <> ''
  GROUP BY host HAVING sum(CASE rv WHEN 'block' THEN 1 WHEN 'allow' THEN -1 ELSE 0 END) > 0
)
SELECT page_id, host, path, rule,
       coalesce(rv, CASE WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM r
"""
