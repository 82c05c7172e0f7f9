from datetime import date

import pytest

from batchgauge.config import CheckSpec, ColumnSpec
from batchgauge.errors import QualityError, ValidationError
from batchgauge.operators import gates

COLUMNS = ColumnSpec(("txn_id",), ("amount", "risk"), ("p",))
IN = "txn_id string, amount double, risk double"
OUT = "txn_id string, p double, run_date date"


def scored(spark, values):
    return spark.createDataFrame([(f"T{i}", v, date(2024, 1, 1)) for i, v in enumerate(values)], OUT)


def test_valid_input_and_extra_columns(spark):
    gates.check_input(spark.createDataFrame([("T1", 1.0, 2.0, "x")], IN + ", more string"), COLUMNS)


def test_input_failures_in_order(spark):
    with pytest.raises(ValidationError, match="empty"):
        gates.check_input(spark.createDataFrame([], "other int"), COLUMNS)
    with pytest.raises(ValidationError, match=r"Missing id_columns: \['txn_id'\]"):
        gates.check_input(spark.createDataFrame([(1.0,)], "amount double"), COLUMNS)
    with pytest.raises(ValidationError, match=r"Missing feature_columns: \['amount', 'risk'\]"):
        gates.check_input(spark.createDataFrame([("T1",)], "txn_id string"), COLUMNS)


def test_valid_output(spark):
    gates.check_output(scored(spark, [0.1, 0.9]), COLUMNS, CheckSpec(prediction_range={"p": (0.0, 1.0)}))


def test_empty_output_and_missing_column(spark):
    with pytest.raises(ValidationError, match="empty"):
        gates.check_output(scored(spark, []), COLUMNS, CheckSpec())
    with pytest.raises(ValidationError, match=r"Missing output_columns: \['p'\]"):
        gates.check_output(scored(spark, [0.1]).drop("p"), COLUMNS, CheckSpec())


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_scores(spark, bad):
    df = scored(spark, [0.1, bad, 0.8])
    with pytest.raises(QualityError, match=r"Column 'p' has 33.3% NaN values \(threshold: 0.0%\)"):
        gates.check_output(df, COLUMNS, CheckSpec())
    gates.check_output(df, COLUMNS, CheckSpec(null_output_max_pct=50.0))


def test_null_threshold_is_strict(spark):
    gates.check_output(scored(spark, [0.1, None]), COLUMNS, CheckSpec(null_output_max_pct=50.0))
    with pytest.raises(QualityError):
        gates.check_output(scored(spark, [0.1, None]), COLUMNS, CheckSpec(null_output_max_pct=49.9))


def test_range(spark):
    limits = CheckSpec(prediction_range={"p": (0.0, 1.0)}, null_output_max_pct=100.0)
    with pytest.raises(QualityError, match=r"Column 'p' has 1 values outside range \[0.0, 1.0\]"):
        gates.check_output(scored(spark, [0.1, 1.5, 0.8]), COLUMNS, limits)
    # NaN is not above the range, and the bounds belong to it.
    gates.check_output(scored(spark, [0.0, 1.0, float("nan"), None]), COLUMNS, limits)
    gates.check_output(scored(spark, [0.1, 999.0, -5.0]), COLUMNS, CheckSpec())
    gates.check_output(scored(spark, [0.1]), COLUMNS, CheckSpec(prediction_range={"absent": (0.0, 1.0)}))


def test_report_per_day_and_unevaluated_checks(spark):
    checks = CheckSpec(prediction_range={"p": (0.0, 1.0)})
    report = gates.output_report(scored(spark, []), COLUMNS, checks).collect()
    assert [r["passed"] for r in sorted(report, key=lambda r: r["seq"])] == [False, None, None, None]
    df = spark.createDataFrame(
        [("a", 2.0, date(2024, 1, 1)), ("b", None, date(2024, 1, 2)), ("c", 0.5, date(2024, 1, 3))], OUT
    )
    first = gates.first_failure(gates.output_report(df, COLUMNS, checks, ["run_date"]), ["run_date"])
    got = {r["run_date"].day: (r["error"], (r["message"] or "")[:16]) for r in first.collect()}
    assert got == {1: ("QualityError", "Column 'p' has 1"), 2: ("QualityError", "Column 'p' has 1"), 3: (None, "")}


def test_all_gates_are_one_aggregate(spark):
    checks = CheckSpec(prediction_range={"p": (0.0, 1.0)})
    plan = gates.output_report(scored(spark, [0.1]), COLUMNS, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_feature_nulls_and_output_stats(spark):
    df = spark.createDataFrame([(1.0, None, "x"), (float("nan"), 2.0, None), (3.0, 4.0, "y"), (5.0, 6.0, "z")],
                               "a double, b double, s string")
    nulls = {r["column"]: r["null_pct"] for r in gates.feature_null_report(df, ["a", "b", "s"]).collect()}
    assert nulls == {"a": 25.0, "b": 25.0, "s": 25.0}
    a = {r["column"]: r for r in gates.output_stats(df, ["a", "b"]).collect()}["a"]
    assert (a["min"], a["max"], a["mean"], a["null_count"]) == (1.0, 5.0, 3.0, 1)
