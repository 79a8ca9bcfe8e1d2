"""The training-data pipeline: every stage works on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet
and read again as the next stage's documents. All but the last return the columns
of ``documents``. Rows are never sampled or capped; a null or wordless text is
dropped by the language stage, as it has no language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import credentials, decontaminate, jaccard, langid, packing
from kestrel.llm.common import keep_batches_small, saved, sized
from kestrel.llm.queries import PACK_END_ID, SEQUENCE_LENGTH, TOKENIZER, language_model
from kestrel.session import scratch_path
from kestrel.sources.tables import load_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language: all with a letter, also where no row is
    labelled. The model learns from the rows of this stage's own input that aren't
    held out."""
    keep_batches_small(spark)
    return langid.identified(docs, language_model(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal or linked texts the row with the smallest doc_id, and
    of equal rows one. Rows of one doc_id with different texts are documents of
    their own, linked or not by their texts. Rows without doc_id all stay."""
    key, own, text = (_free(docs, name) for name in ("_key", "_own", "_text"))
    ids = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias(text))
    several = saved(ids.groupBy("doc_id").agg(F.min(text).alias("x"), F.max(text).alias("y")).where("x <> y").select(
        F.col("doc_id").alias(own)), "pipeline-ids")
    rows = docs.join(sized(several), docs["doc_id"] == F.col(own), "left").withColumn(
        key, F.when(F.col(own).isNull(), docs["doc_id"]).otherwise(F.xxhash64("doc_id", "text"))).drop(own)

    groups = jaccard.similar_components(rows.select(F.col(key).alias("doc_id"), "text")).where("doc_id IS NOT NULL").select(
        "doc_id", "component_id").distinct()
    if not several.isEmpty():
        # the keys of these rows aren't in the order of their doc_ids
        groups = saved(groups, "pipeline-groups")
        named = saved(rows.where(rows["doc_id"] != rows[key]).select(F.col(key).alias("doc_id"), F.col("doc_id").alias("id")).distinct(),
                      "pipeline-ids")
        of_id = groups.join(sized(named), "doc_id", "left")
        some = of_id.where("id IS NOT NULL").select("component_id").distinct()
        first = of_id.join(sized(saved(some, "pipeline-groups")), "component_id", "left_semi").groupBy("component_id").agg(
            F.min(F.struct(F.coalesce("id", "doc_id"), "doc_id"))["doc_id"].alias("first"))
        groups = groups.join(sized(saved(first, "pipeline-groups")), "component_id", "left").select(
            "doc_id", F.coalesce("first", "component_id").alias("component_id"))
    dropped = groups.where("doc_id <> component_id").select(F.col("doc_id").cast("string").alias("_dropped"))
    row = F.concat(F.lit("row "), F.monotonically_increasing_id())
    keyed = rows.withColumn(key, F.coalesce(rows[key].cast("string"), F.when(rows["doc_id"].isNull(), row)))
    left = keyed.join(dropped, keyed[key] == dropped["_dropped"], "left_anti")
    return left.dropDuplicates([key]).select(*docs.columns)


def _free(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column has it."""
    while name in docs.columns:
        name += "_"
    return name


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    keep_batches_small(spark)
    return decontaminate.without_contaminated(docs, load_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; n_chars follows the text."""
    keep_batches_small(spark)
    return credentials.redact(docs, length_col="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    keep_batches_small(spark)
    return packing.pack(docs, TOKENIZER, PACK_END_ID, SEQUENCE_LENGTH)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("packing", pack_sequences),
]

#: Language models, similarity joins and tokenizers aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
