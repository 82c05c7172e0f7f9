from datetime import date, datetime

import pytest

from batchgauge.config import CheckSpec, ColumnSpec, Project
from batchgauge.operators import alerts, monitor

D = date(2024, 1, 3)
PROJECT = Project("p1", schema=ColumnSpec(("id",), ("f",), ("a", "b")),
                  monitoring=CheckSpec(20.0, 10.0, {"a": (0.0, 1.0), "absent": (0, 1)}))
LOG = "project_id string, run_date date, status string, row_count long, created_at timestamp"


def result(spark, rows, day=D):
    return spark.createDataFrame([(i, a, b, day) for i, (a, b) in enumerate(rows)],
                                 "id int, a double, b double, run_date date")


def run(day, status, n, hour=0, project="p1"):
    return (project, date(2024, 1, day), status, n, datetime(2024, 1, day, hour))


def report(spark, rows, log, project=PROJECT):
    log = spark.createDataFrame(log, LOG)
    return {r["check_name"]: r for r in monitor.monitor_report(result(spark, rows), log, project).collect()}


def test_no_previous_run_passes_with_the_count(spark):
    r = report(spark, [(0.5, 0.5)] * 4, [])["row_count_change"]
    assert (r["passed"], r["value"], r["threshold"]) == (True, 4.0, 20.0)
    assert r["message"] == "No previous run to compare (count=4)"


def test_previous_zero_passes(spark):
    assert report(spark, [(0.5, 0.5)] * 4, [run(2, "success", 0)])["row_count_change"]["value"] == 4.0


@pytest.mark.parametrize("previous, passed, value", [(5, True, 20.0), (6, False, 33.3), (3, False, 33.3), (4, True, 0.0)])
def test_row_count_change(spark, previous, passed, value):
    r = report(spark, [(0.5, 0.5)] * 4, [run(2, "success", previous)])["row_count_change"]
    assert (r["passed"], r["value"]) == (passed, value)


def test_row_count_message(spark):
    r = report(spark, [(0.5, 0.5)] * 4, [run(2, "success", 6)])["row_count_change"]
    assert r["message"] == "Row count changed 33.3% (6 -> 4, max allowed: 20.0%)"


def test_previous_run_is_the_last_success_strictly_before(spark):
    log = [run(1, "success", 4), run(2, "failed", 100), run(2, "skipped", 0, 1), run(3, "success", 50),
           run(4, "success", 60), run(2, "success", 70, project="other")]
    assert report(spark, [(0.5, 0.5)] * 4, log)["row_count_change"]["value"] == 0.0
    # Two successful runs on one date: the later one counts.
    log = [run(2, "success", 100, 1), run(2, "success", 4, 2)]
    assert report(spark, [(0.5, 0.5)] * 4, log)["row_count_change"]["passed"]


def test_null_outputs_over_all_cells(spark):
    r = report(spark, [(None, 0.5), (0.5, float("nan")), (0.5, 0.5), (0.1, 0.1)], [])["null_outputs"]
    assert (r["passed"], r["value"], r["message"]) == (False, 25.0, "25.00% NaN in output columns (max: 10.0%)")


def test_no_output_columns(spark):
    project = Project("p1", schema=ColumnSpec(("id",), ("f",), ()), monitoring=CheckSpec())
    r = report(spark, [(0.1, 0.1)], [], project)["null_outputs"]
    assert (r["passed"], r["value"], r["message"]) == (True, 0.0, "No output cells to check")


def test_range(spark):
    got = report(spark, [(1.5, 0.0), (0.5, 0.0), (None, 0.0), (float("nan"), 9.0)], [])
    r = got["range_a"]
    assert (r["passed"], r["value"], r["threshold"]) == (False, 50.0, 0.0)
    assert r["message"] == "1/2 values outside [0.0, 1.0] (50.00%)"
    assert "range_absent" not in got


def test_range_of_all_missing_column(spark):
    r = report(spark, [(None, 0.0), (float("nan"), 0.0)], [])["range_a"]
    assert (r["passed"], r["value"], r["threshold"], r["message"]) == (True, None, None, "No non-null values in 'a'")


def test_summary_and_alert_text(spark):
    rows = monitor.monitor_report(result(spark, [(1.5, None)]), spark.createDataFrame([], LOG), PROJECT)
    s = monitor.check_summary(rows).head()
    assert (s["n_checks"], s["n_failed"], s["all_passed"]) == (3, 2, False)
    a = alerts.alert_messages(rows, "#c").head()
    assert a["message"] == (
        "[!!!] [CRITICAL] p1 — Monitoring alerts for **p1** on `2024-01-03`:\n"
        "- null_outputs: 50.00% NaN in output columns (max: 10.0%)\n"
        "- range_a: 1/1 values outside [0.0, 1.0] (100.00%)"
    )
    assert (a["channel"], a["severity"], a["n_failed"]) == ("#c", "critical", 2)
    quiet = monitor.monitor_report(result(spark, [(0.5, 0.5)]), spark.createDataFrame([], LOG), PROJECT)
    assert alerts.alert_messages(quiet).count() == 0


def test_severity_prefixes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("critical",), ("warning",), ("info",), ("unknown",)], "s string")
    got = [r[0] for r in df.select(alerts.alert_text(F.col("s"), F.lit(""), F.lit("m"))).collect()]
    assert got == ["[!!!] [CRITICAL] m", "[!] [WARNING] m", "[i] [INFO] m", "[?] [UNKNOWN] m"]


def test_a_day_without_rows_is_reported(spark):
    log = spark.createDataFrame([run(2, "success", 5)], LOG)
    rows = monitor.monitor_report(result(spark, []), log, PROJECT, [D]).collect()
    got = {r["check_name"]: r for r in rows}
    assert {r["run_date"] for r in rows} == {D} and {r["project_id"] for r in rows} == {"p1"}
    assert (got["row_count_change"]["passed"], got["row_count_change"]["value"]) == (False, 100.0)
    assert got["null_outputs"]["passed"] and got["range_a"]["message"] == "No non-null values in 'a'"
    both = monitor.monitor_report(result(spark, [(0.5, 0.5)] * 5), log, PROJECT, [D, date(2024, 1, 4)])
    count = {r["run_date"].day: r["passed"] for r in both.filter("check_name = 'row_count_change'").collect()}
    assert count == {3: True, 4: False}
