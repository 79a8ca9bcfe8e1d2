"""Feature preparation (M1, M2, M3) with MLlib transformers.

The reference fits one ``StringIndexer`` per column, on the training set and
then *again* on the test set (D9), so a category can get different codes in
the two. Here one fitted model is applied to both; values not seen in fitting
get the extra code ``numLabels`` (``handleInvalid="keep"``).

MLlib's indexer brings every distinct label to the driver and ships the map
to the executors: right for the reference's few categories (protocol,
service, flag). :func:`index_by_frequency` gives the same codes with the
label table kept distributed, for columns whose distinct values grow with
the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembler(input_cols: Sequence[str], output_col: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    """Numeric columns, in the order named, into one vector (M1).

    ``handle_invalid``: "error" (default, fails on NULL/NaN), "skip" or "keep".
    """
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col,
                           handleInvalid=handle_invalid)


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str = "features",
             handle_invalid: str = "error", as_array: bool = False) -> DataFrame:
    out = assembler(input_cols, output_col, handle_invalid).transform(df)
    if as_array:
        out = out.withColumn(output_col, vector_to_array(output_col))
    return out


def string_indexer(input_cols: Sequence[str], output_cols: Sequence[str] | None = None,
                   handle_invalid: str = "keep") -> StringIndexer:
    """Category -> 0-based DOUBLE code, most frequent first, ties by string order (M2)."""
    output_cols = list(output_cols) if output_cols else [f"_{c}_idx" for c in input_cols]
    return StringIndexer(inputCols=list(input_cols), outputCols=output_cols,
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


MAX_DRIVER_LABELS = 100_000  # distinct labels a StringIndexer may bring to the driver


def check_label_counts(train: DataFrame, input_cols: Sequence[str], limit: int = MAX_DRIVER_LABELS) -> None:
    """Raise if a column has more distinct labels than the driver should hold."""
    counts = train.agg(*[F.count_distinct(c).alias(c) for c in input_cols]).first()
    for c in input_cols:
        if counts[c] > limit:
            raise ValueError(f"{c!r} has {counts[c]} distinct labels, more than {limit}; use index_by_frequency")


def fit_indexer(train: DataFrame, input_cols: Sequence[str],
                handle_invalid: str = "keep") -> PipelineModel:
    """Fit once on training rows; all columns in one aggregation job (M3). The
    labels come to the driver, so their number is checked first."""
    check_label_counts(train, input_cols)
    return Pipeline(stages=[string_indexer(input_cols, handle_invalid=handle_invalid)]).fit(train)


def index_in_place(model: PipelineModel, df: DataFrame, input_cols: Sequence[str]) -> DataFrame:
    """Apply a fitted indexer; each code replaces its source column under its name (M3)."""
    out = model.transform(df)
    return out.withColumns({c: F.col(f"_{c}_idx") for c in input_cols}) \
              .drop(*[f"_{c}_idx" for c in input_cols])


def index_columns(train: DataFrame, apply_to: DataFrame, input_cols: Sequence[str],
                  handle_invalid: str = "keep") -> DataFrame:
    """Fit on ``train``, code ``apply_to`` with the same labels."""
    return index_in_place(fit_indexer(train, input_cols, handle_invalid), apply_to, input_cols)


def frequency_codes(train: DataFrame, col: str, code: str = "code") -> DataFrame:
    """(value, code): 0-based DOUBLE codes, most frequent value first, ties by
    value - the labels of a fitted ``StringIndexer``, computed without the
    driver: counts by ``groupBy``, ranks by the range-partitioned row index.
    NULL is not a label. Ties compare values in Spark's string order (code
    points); MLlib's indexer compares UTF-16 units, which differs only between
    characters above U+FFFF and those in U+E000-U+FFFF.
    """
    from .ordering import with_row_index

    counts = train.where(F.col(col).isNotNull()).groupBy(col).count()
    ranked = with_row_index(counts, [F.col("count").desc(), F.col(col).asc()], name="_rank")
    return ranked.select(col, F.col("_rank").cast("double").alias(code))


def index_by_frequency(train: DataFrame, apply_to: DataFrame, cols, handle_invalid: str = "keep"):
    """Replace each column in ``cols`` by its frequency code fitted on ``train``.

    The scale-safe form of :func:`index_columns` for columns with many
    distinct values: the label table stays a DataFrame and is joined back
    (broadcast only when Spark's size estimate allows it, otherwise a
    sort-merge join with AQE skew splitting). Unseen values and NULL get the
    code ``number of labels`` (``"keep"``) or drop the row (``"skip"``).
    """
    if handle_invalid not in ("keep", "skip"):
        raise ValueError("handle_invalid must be 'keep' or 'skip'")
    out = apply_to
    for c in cols:
        codes = frequency_codes(train, c, code="_code")
        n_labels = codes.count()  # one number
        out = out.join(codes, c, "left" if handle_invalid == "keep" else "inner")
        out = out.withColumn(c, F.coalesce(F.col("_code"), F.lit(float(n_labels)))).drop("_code")
    return out
