"""Feature preparation, synthetic labels and training for the example projects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from batchgauge.functions.columns import (
    col, hash_normal, hash_uniform, logistic, missing, per_column, present, standardise, unit_interval,
)
from batchgauge.functions.quantiles import exact_quantiles

# The noise, slope and quantile of the synthetic label rule, and the training setup.
NOISE_STD = 0.15
SLOPE = 10.0
MIDPOINT_QUANTILE = 0.95
ROUNDS = 200
LEARNING_RATE = 0.05
MIN_CHILD_ROWS = 100
FEATURE_SHARE = 0.8
ROW_SHARE = 0.8


def fit_quantile(df: DataFrame, columns: Sequence[str], p: float) -> dict[str, float]:
    """column -> exact quantile. Collected: one number per column."""
    rows = exact_quantiles(df, columns, [p]).collect()
    return {r["column"]: r["quantiles"][0] for r in rows}


def fill_missing(df: DataFrame, fitted: Mapping[str, float]) -> DataFrame:
    """Missing values become the column's fitted number; a column without one stays."""
    return df.withColumns({
        c: F.when(missing(df, c), F.lit(v)).otherwise(col(c)) for c, v in fitted.items()
    })


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values become the column's median."""
    return fill_missing(df, fit_quantile(df, columns, 0.5))


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """column -> (min, max) of what is not missing. Collected: two numbers per column."""
    ends = per_column(df, columns, {
        "low": lambda c: F.min(present(df, c)), "high": lambda c: F.max(present(df, c)),
    })
    return {r["column"]: (r["low"], r["high"]) for r in ends.collect()}


def scale_min_max(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Fitted columns scaled to [0, 1]; a constant column is 0.5."""
    return df.withColumns({c: unit_interval(col(c).cast("double"), low, high) for c, (low, high) in fitted.items()})


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale columns to [0, 1] by their own range."""
    return scale_min_max(df, fit_min_max(df, columns))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """column -> (mean, population standard deviation). Collected: two numbers per column."""
    moments = per_column(df, columns, {
        "mean": lambda c: F.avg(present(df, c)), "std": lambda c: F.stddev_pop(present(df, c)),
    })
    return {r["column"]: (r["mean"], r["std"]) for r in moments.collect()}


def apply_scaler(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Replace the fitted columns by their standard scores; others stay."""
    return df.withColumns({c: standardise(col(c), m, s) for c, (m, s) in fitted.items()})


def logistic_from_quantile(df: DataFrame, column: str, p: float = MIDPOINT_QUANTILE, slope: float = SLOPE) -> Column:
    """Logistic of a column around its own quantile."""
    middle = fit_quantile(df, [column], p).get(column)
    return logistic(F.lit(slope) * (col(column) - F.lit(middle)))


def risk_score(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """df plus ``risk``: the weighted sum of imputed, min-max scaled columns."""
    names = list(weights)
    medians, ranges = fit_quantile(df, names, 0.5), fit_min_max(df, names)
    risk = F.lit(0.0)
    for c, w in weights.items():
        filled = F.when(missing(df, c), F.lit(medians.get(c))).otherwise(col(c).cast("double"))
        risk = risk + F.lit(float(w)) * unit_interval(filled, *ranges[c])
    return df.withColumn("risk", risk)


def synthetic_labels(
    df: DataFrame, weights: Mapping[str, float], keys: Sequence[str], seed: int = 42
) -> DataFrame:
    """df plus ``risk``, ``probability`` and a drawn 0/1 ``label``, the same on every run."""
    ids = [col(k) for k in keys]
    noisy = risk_score(df, weights).withColumn("risk", F.col("risk") + hash_normal(ids, seed) * NOISE_STD)
    drawn = noisy.withColumn("probability", logistic_from_quantile(noisy, "risk"))
    return drawn.withColumn("label", (hash_uniform(ids, seed, "label") < F.col("probability")).cast("int"))


def label_balance(df: DataFrame, label: str) -> DataFrame:
    """n, positives and rate of a 0/1 label."""
    y = col(label)
    return df.agg(F.count(y).alias("n"), F.sum(y).alias("positives"), F.avg(y).alias("rate"))


def train_boosted(
    train: DataFrame, features: Sequence[str], label: str, rounds: int = ROUNDS, seed: int = 42
):
    """A gradient-boosted tree classifier fitted on the cluster.

    Depth 5 gives up to 32 leaves. The session's checkpoint folder, where set, cuts the
    lineage of the rounds.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=list(features), outputCol="features").transform(train).select("features", label)
    trees = GBTClassifier(
        labelCol=label, featuresCol="features", maxIter=rounds, stepSize=LEARNING_RATE, maxDepth=5,
        minInstancesPerNode=MIN_CHILD_ROWS, featureSubsetStrategy=str(FEATURE_SHARE),
        subsamplingRate=ROW_SHARE, seed=seed, checkpointInterval=10,
    )
    return trees.fit(rows)


def score_boosted(model, df: DataFrame, features: Sequence[str], output: str = "score") -> DataFrame:
    """df plus the model's probability of class 1."""
    from batchgauge.operators.scoring import fitted_scorer

    return fitted_scorer(_as_features(model), output, features)(df)


def _as_features(model):
    return model.copy({model.featuresCol: "_features"})


def feature_importance(spark, model, features: Sequence[str]) -> DataFrame:
    """feature, importance: one row per feature of a fitted model."""
    rows = [(n, float(v)) for n, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")
