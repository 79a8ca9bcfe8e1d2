"""Binary logistic regression and its evaluation (M4, M5, M6; flows of A13, A14).

Reference settings: elastic net with ``regParam=0.03``, ``elasticNetParam=0.8``,
``maxIter`` 10 (4 float features) or 100 (41 mixed features). The optimizer
runs as MLlib's distributed tree aggregation per iteration; only the weight
vector travels to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import assembler, check_label_counts, string_indexer
from .relational import binarize

# --- fixed values (the reference's regression settings) ---
REG_PARAM = 0.03
ELASTIC_NET = 0.8
MAX_ITER_FOUR_FEATURES = 10
MAX_ITER_CONNECTION_RECORDS = 100
# ---


def logistic_regression(features_col: str = "features", label_col: str = "y",
                        max_iter: int = 10, reg_param: float = REG_PARAM,
                        elastic_net: float = ELASTIC_NET) -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, regParam=reg_param,
                              elasticNetParam=elastic_net, featuresCol=features_col,
                              labelCol=label_col, family="binomial")


def classifier(numeric_cols: Sequence[str], categorical_cols: Sequence[str] = (),
               label_col: str = "y", max_iter: int = 10,
               reg_param: float = REG_PARAM, elastic_net: float = ELASTIC_NET,
               handle_invalid: str = "error") -> Pipeline:
    """Index categoricals (fit once, unseen -> extra code), assemble, regress.

    Feature order: the categorical codes first, then the numeric columns, as in
    the reference's column order (categoricals at positions 1-3 there are
    re-appended after indexing; order does not change the fit).
    ``handle_invalid`` goes to the assembler: "error" (the reference's
    behaviour: a NULL feature fails the fit), "skip" drops such rows, "keep"
    keeps NaN.
    """
    stages = []
    cat_out = [f"_{c}_idx" for c in categorical_cols]
    if categorical_cols:
        stages.append(string_indexer(categorical_cols, cat_out, handle_invalid="keep"))
    stages.append(assembler(list(cat_out) + list(numeric_cols), "features", handle_invalid))
    stages.append(logistic_regression("features", label_col, max_iter, reg_param, elastic_net))
    return Pipeline(stages=stages)


def fit(train: DataFrame, numeric_cols: Sequence[str], categorical_cols: Sequence[str] = (),
        label_col: str = "y", max_iter: int = 10, **kw) -> PipelineModel:
    """Fit the whole preparation + regression on training rows only."""
    if categorical_cols:
        check_label_counts(train, categorical_cols)
    return classifier(numeric_cols, categorical_cols, label_col, max_iter, **kw).fit(train)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (),
          label_col: str = "y") -> DataFrame:
    """``keep`` columns, label, ``probability`` as ARRAY<DOUBLE>, ``prediction`` (M5)."""
    out = model.transform(df)
    return out.select(*keep, label_col, vector_to_array("probability").alias("probability"),
                      "prediction")


def coefficients(model: PipelineModel | LogisticRegressionModel, spark: SparkSession,
                 feature_names: Sequence[str]) -> DataFrame:
    """(feature, weight) rows plus one ``(intercept)`` row (M6)."""
    lr = model.stages[-1] if isinstance(model, PipelineModel) else model
    weights = lr.coefficients.toArray().tolist()
    rows = [(n, float(w)) for n, w in zip(feature_names, weights)]
    rows.append(("(intercept)", float(lr.intercept)))
    return spark.createDataFrame(rows, "feature string, weight double")


def optimality(model: PipelineModel | LogisticRegressionModel, train: DataFrame,
               feature_names: Sequence[str], label_col: str = "y", reg_param: float = REG_PARAM,
               elastic_net: float = ELASTIC_NET) -> DataFrame:
    """How far the weights are from the conditions of the penalized minimum (M4, M6).

    Weights w and features are taken in units of a feature's sample deviation, as the
    penalty is. With g the gradient of the mean log loss, the minimum has
    g + reg * ((1 - a) w + a sign(w)) = 0 where w isn't 0, |g| <= reg * a where it is,
    and g = 0 for the intercept. (feature, weight, gradient, curvature, violation):
    ``violation`` is what is missing to that; ``curvature`` the loss's second derivative,
    so violation / curvature is about how far the weight is off. A constant feature has
    no unit: its weight must be 0.

    One distributed aggregate over the training rows: a few sums a feature.
    ``feature_names`` are columns of ``train``, or of the model's preparation.
    """
    lr = model.stages[-1] if isinstance(model, PipelineModel) else model
    data = model.transform(train) if isinstance(model, PipelineModel) else train
    weights, names = lr.coefficients.toArray().tolist(), list(feature_names)
    rows = data.select(F.col(label_col).cast("double").alias("_y"),
                       *(F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(names)))
    margin = F.lit(float(lr.intercept))
    for j, w in enumerate(weights):
        margin = margin + F.lit(w) * F.col(f"_x{j}")
    rows = rows.withColumn("_p", 1 / (1 + F.exp(-margin)))
    error, spread = F.col("_p") - F.col("_y"), F.col("_p") * (1 - F.col("_p"))
    sums = [F.avg(error).alias("e"), F.avg(spread).alias("c")]
    for j in range(len(names)):
        x = F.col(f"_x{j}")
        sums += [F.avg(error * x).alias(f"e{j}"), F.avg(spread * x * x).alias(f"c{j}"), F.stddev_samp(x).alias(f"s{j}")]
    r = rows.agg(*sums).first()
    out = []
    for j, (name, w) in enumerate(zip(names, weights)):
        s = r[f"s{j}"] or 0.0
        if s == 0.0:
            out.append((name, w, 0.0, 0.0, abs(w)))
            continue
        g, unit = r[f"e{j}"] / s, w * s
        bound = reg_param * elastic_net
        pull = g + reg_param * (1 - elastic_net) * unit
        violation = abs(pull + (bound if unit > 0 else -bound)) if unit else max(0.0, abs(g) - bound)
        out.append((name, w, g, r[f"c{j}"] / s / s, violation))
    out.append(("(intercept)", float(lr.intercept), r["e"] or 0.0, r["c"] or 0.0, abs(r["e"] or 0.0)))
    return train.sparkSession.createDataFrame(out, "feature string, weight double, gradient double, curvature double, violation double")


def feature_names(numeric_cols: Sequence[str], categorical_cols: Sequence[str] = ()) -> list[str]:
    return list(categorical_cols) + list(numeric_cols)


def label_binary(df: DataFrame, source: str, positive, out: str = "y") -> DataFrame:
    """FLOAT label: 1.0 where ``source == positive``."""
    return df.withColumn(out, binarize(source, positive))


def probability_of(scored: DataFrame, cls: int = 1) -> F.Column:
    return F.get(F.col("probability"), cls)
