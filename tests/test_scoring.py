from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from batchgauge.config import ColumnSpec
from batchgauge.operators import scoring

COLUMNS = ColumnSpec(("id",), ("f1", "f2"), ("p",))


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([("A", 1.0, 2.0, 9), ("B", 3.0, 4.0, 9), ("C", 5.0, 6.0, 9)], "id string, f1 double, f2 double, extra int")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_expression_scorer_keeps_ids_and_adds_the_date(batch):
    scorer = scoring.expression_scorer(lambda: {"p": F.col("f1") + F.col("f2")})
    out = scoring.scored_batch(batch, scorer, COLUMNS, "2024-01-02")
    assert out.columns == ["id", "p", "run_date"]
    assert rows(out) == [("A", 3.0, date(2024, 1, 2)), ("B", 7.0, date(2024, 1, 2)), ("C", 11.0, date(2024, 1, 2))]


@pytest.mark.parametrize("shape", ["frame", "series", "array"])
def test_one_output_in_any_shape(batch, shape):
    def predict(model, x):
        assert list(x.columns) == ["f1", "f2"]  # no ids, declared order
        total = x["f1"] * model + x["f2"]
        return {"frame": pd.DataFrame({"p": total}), "series": total, "array": total.to_numpy()}[shape]

    out = scoring.scored_batch(batch, scoring.batch_scorer(lambda: 10.0, predict, COLUMNS), COLUMNS, "2024-01-02")
    assert [(r[0], r[1]) for r in rows(out)] == [("A", 12.0), ("B", 34.0), ("C", 56.0)]


def test_two_outputs_take_their_names_from_the_project(batch):
    columns = ColumnSpec(("id",), ("f1", "f2"), ("pred_a", "pred_b"))
    scorer = scoring.batch_scorer(lambda: None, lambda m, x: np.column_stack([x["f1"], x["f2"]]), columns)
    out = scoring.scored_batch(batch, scorer, columns, "2024-01-02")
    assert out.columns == ["id", "pred_a", "pred_b", "run_date"]
    assert rows(out)[0][:3] == ("A", 1.0, 2.0)


def test_python_scorer_reads_only_what_it_needs(spark, batch, tmp_path):
    batch.write.parquet(str(tmp_path / "b"))
    scorer = scoring.batch_scorer(lambda: None, lambda m, x: x["f1"], COLUMNS)
    plan = scorer(spark.read.parquet(str(tmp_path / "b")))._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan


def test_nan_scores_become_null(batch):
    scorer = scoring.expression_scorer(lambda: {"p": F.when(F.col("id") == "A", F.lit(float("nan"))).otherwise(1.0)})
    out = scoring.scored_batch(batch, scorer, COLUMNS, "2024-01-02")
    assert [r[1] for r in rows(out)] == [None, 1.0, 1.0]


def test_dates_as_a_column(spark):
    df = spark.createDataFrame([("A", 1.0, 1.0, date(2024, 1, 1)), ("B", 1.0, 2.0, date(2024, 1, 2))],
                               "id string, f1 double, f2 double, day date")
    scorer = scoring.batch_scorer(lambda: None, lambda m, x: x["f2"], COLUMNS, carry=["run_date"])
    out = scoring.scored_batch(df, scorer, COLUMNS, F.col("day"))
    assert rows(out) == [("A", 1.0, date(2024, 1, 1)), ("B", 2.0, date(2024, 1, 2))]
    with pytest.raises(ValueError, match="carry run_date"):
        scoring.scored_batch(df, scoring.batch_scorer(lambda: None, lambda m, x: x["f2"], COLUMNS), COLUMNS, F.col("day"))


def test_names_with_special_characters(spark):
    columns = ColumnSpec(("id",), ("dummy/SOE",), ("a.b",))
    df = spark.createDataFrame([(1, 2.0)], ["id", "dummy/SOE"])
    out = scoring.scored_batch(df, scoring.batch_scorer(lambda: None, lambda m, x: x["dummy/SOE"], columns), columns, "2024-01-02")
    assert out.columns == ["id", "a.b", "run_date"] and out.head()[1] == 2.0


def test_fitted_model_gives_probability_of_class_one(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([(i, float(i % 10), int(i % 10 > 4)) for i in range(100)], "id int, x double, y int")
    train = VectorAssembler(inputCols=["x"], outputCol="_features").transform(df)
    model = LogisticRegression(featuresCol="_features", labelCol="y").fit(train)
    out = scoring.fitted_scorer(model, "p", ["x"])(df)
    got = {r["x"]: r["p"] for r in out.collect()}
    assert got[0.0] < 0.5 < got[9.0] and out.columns == ["id", "x", "y", "p"]
