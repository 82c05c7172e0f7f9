"""Scoring: features in, declared outputs out, ids kept in the same row.

A scorer is ``DataFrame -> DataFrame`` that adds the output columns. Because ids
never leave their row there is no join back after prediction.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from batchgauge.config import ColumnSpec
from batchgauge.functions.columns import col, nan_to_null

Scorer = Callable[[DataFrame], DataFrame]

# Functions of this package travel to Python workers by value: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules["batchgauge"])


def expression_scorer(outputs: Mapping[str, Column] | Callable[[], Mapping[str, Column]]) -> Scorer:
    """A model written as Column expressions, or a function that makes them: stays in generated code."""
    return lambda df: df.withColumns(dict(outputs() if callable(outputs) else outputs))


def fitted_scorer(model, output: str, features: Sequence[str]) -> Scorer:
    """A pyspark.ml model; the output is the probability of class 1, or the raw prediction."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    def score(df: DataFrame) -> DataFrame:
        assembled = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
        scored = model.transform(assembled.transform(df))
        if "probability" in scored.columns:
            value = vector_to_array("probability")[1]
        else:
            value = F.col("prediction")
        return scored.withColumn(output, value).select(*[col(c) for c in df.columns], col(output))

    return score


def as_frame(predicted, outputs: Sequence[str]) -> pd.DataFrame:
    """Name what a model returned: a frame keeps its names, one column gets the first output."""
    if isinstance(predicted, pd.DataFrame):
        return predicted
    values = np.asarray(predicted)
    return pd.DataFrame(values, columns=list(outputs) if values.ndim > 1 else [outputs[0]])


def batch_scorer(
    load: Callable[[], object],
    predict: Callable[[object, pd.DataFrame], object],
    columns: ColumnSpec,
    output_types: Mapping[str, T.DataType] | None = None,
    carry: Sequence[str] = (),
) -> Scorer:
    """A model called from Python on Arrow batches; ``load`` runs once per task.

    The model sees the feature columns only, in declared order. Ids and ``carry``
    columns go around it.
    """
    kept = list(dict.fromkeys([*columns.id_columns, *carry]))
    features, outputs = list(columns.feature_columns), list(columns.output_columns)
    types = dict(output_types or {})

    def score_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            scores = as_frame(predict(model, batch[features]), outputs)[outputs].reset_index(drop=True)
            yield pd.concat([batch[kept].reset_index(drop=True), scores], axis=1)

    def score(df: DataFrame) -> DataFrame:
        # Project first: the scan then reads only what crosses to Python.
        needed = df.select(*[col(c) for c in dict.fromkeys([*kept, *features])])
        schema = T.StructType(
            [df.schema[c] for c in kept]
            + [T.StructField(o, types.get(o, T.DoubleType())) for o in outputs]
        )
        return needed.mapInPandas(score_batches, schema)

    return score


def scored_batch(
    batch: DataFrame, scorer: Scorer, columns: ColumnSpec, run_date: str | date | Column
) -> DataFrame:
    """ids, outputs and run_date of a scored batch, with NaN scores as NULL.

    ``run_date`` is one date, or a date column of the batch (a range of days at once).
    """
    day = run_date if isinstance(run_date, Column) else F.lit(str(run_date))
    dated = batch.withColumn("run_date", day.cast("date"))
    scored = scorer(dated)
    if "run_date" not in scored.columns:
        if isinstance(run_date, Column):
            raise ValueError("a scorer over several dates must carry run_date")
        scored = scored.withColumn("run_date", day.cast("date"))
    present = [c for c in columns.output_columns if c in scored.columns]
    names = dict.fromkeys([*columns.id_columns, *present, "run_date"])
    return nan_to_null(scored.select(*[col(c) for c in names]))
