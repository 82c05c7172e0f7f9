from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from batchgauge.config import (
    CheckSpec, ColumnSpec, DriftSpec, EvalSpec, ModelRef, OutputSpec, Project, SourceSpec,
)
from batchgauge.errors import QualityError, ValidationError
from batchgauge.operators.scoring import batch_scorer, expression_scorer
from batchgauge.plans import jobs

COLUMNS = ColumnSpec(("id",), ("f",), ("p",))
PROJECT = Project("p1", model=ModelRef("m"), schema=COLUMNS, output=OutputSpec("results.scores"),
                  monitoring=CheckSpec(50.0, 0.0, {"p": (0.0, 1.0)}, DriftSpec(True), "#c"))
SCORER = expression_scorer(lambda: {"p": F.col("f") / 10})
IN = "id string, f double, run_date date"


def days(spark, spec):
    rows = [(f"{d}-{i}", float(v), date(2024, 1, d)) for d, values in spec.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, IN)


def log(store):
    return [(r["run_date"].day, r["status"], r["row_count"], r["error_message"])
            for r in sorted(store.read("run_log").collect(), key=lambda r: (r["run_date"], r["created_at"]))]


def saved(store):
    return sorted((r["run_date"].day, r["p"]) for r in store.spark.read.parquet(store.path("results.scores")).collect())


def test_daily_run_from_a_file(spark, store, tmp_path):
    (tmp_path / "b_2024-01-02.csv").write_text("id,f\na,1\nb,2\n")
    project = replace(PROJECT, input=SourceSpec("file", {"path": str(tmp_path / "b_{run_date}.csv")}))
    assert jobs.daily_run(spark, store, project, SCORER, "2024-01-02") == "success"
    assert saved(store) == [(2, 0.1), (2, 0.2)]
    assert jobs.daily_run(spark, store, project, SCORER, "2024-01-02") == "skipped"
    assert log(store) == [(2, "success", 2, None), (2, "skipped", 0, None)]


@pytest.mark.parametrize("rows, error, text", [
    ([], ValidationError, "empty"), ([("a", 50.0)], QualityError, "1 values outside range"), ([("a", None)], QualityError, "100.0% NaN"),
])
def test_failure_is_logged_and_raised(spark, store, rows, error, text):
    batch = spark.createDataFrame(rows, "id string, f double")
    with pytest.raises(error, match=text):
        jobs.daily_run(spark, store, PROJECT, SCORER, "2024-01-02", batch)
    (entry,) = log(store)
    assert entry[:3] == (2, "failed", 0) and text in entry[3]


def test_scorer_failure_is_logged(spark, store):
    def broken(df):
        raise RuntimeError("no model")

    with pytest.raises(RuntimeError):
        jobs.daily_run(spark, store, PROJECT, broken, "2024-01-02", days(spark, {2: [1]}))
    assert log(store) == [(2, "failed", 0, "no model")]


def test_run_with_monitoring_and_drift(spark, store):
    jobs.daily_run(spark, store, PROJECT, SCORER, "2024-01-01", days(spark, {1: [1, 2, 3, 4]}), with_monitoring=True)
    jobs.daily_run(spark, store, PROJECT, SCORER, "2024-01-02", days(spark, {2: [9]}), with_monitoring=True)
    checks = {(r["run_date"].day, r["check_name"]): (r["passed"], r["value"]) for r in store.read("monitoring_log").collect()}
    assert checks[(1, "row_count_change")] == (True, 4.0) and checks[(2, "row_count_change")] == (False, 75.0)
    assert checks[(2, "range_p")] == (True, 0.0)
    scored = days(spark, {2: [9] * 5}).select("id", (F.col("f") / 10).alias("p"), "run_date")
    reference = days(spark, {1: [1, 2, 3, 4]}).select("f", (F.col("f") / 10).alias("p"))
    out = jobs.after_run(store, PROJECT, scored, date(2024, 1, 2), days(spark, {2: [9] * 5}), reference)
    assert {(r["column"], r["severity"]) for r in out["drift"].collect()} == {("p", "critical"), ("f", "critical")}
    assert {r["name"] for r in out["immediate"].collect()} == {"p", "f"}
    assert {(r["column"], r["severity"]) for r in store.read("drift_log").collect()} == {("p", "critical"), ("f", "critical")}
    alerts = [r for r in store.read("alert_log").collect() if r["n_failed"] == 1]
    (alert,) = [r for r in alerts if "row_count_change" in r["message"]]
    assert alert["channel"] == "#c" and "- row_count_change: Row count changed 75.0%" in alert["message"]
    # twice each: the daily run has checked them against the day before, p by the stored scores and f by the feature log
    assert sorted(r["message"].split(" — ")[1][:6] for r in alerts if r is not alert) == ["f: PSI", "f: PSI", "p: PSI", "p: PSI"]


def test_drift_against_the_stored_days_of_the_settings(spark, store):
    checks = replace(PROJECT.monitoring, drift=DriftSpec(enabled=True, reference="last_2_days"), row_count_change_max_pct=1000.0)
    project = replace(PROJECT, monitoring=checks)
    values = {1: [1, 2, 3, 4], 2: [9] * 4, 3: [1, 2], 4: [10] * 4}
    for day, f in values.items():
        jobs.daily_run(spark, store, project, SCORER, f"2024-01-0{day}", days(spark, {day: f}), with_monitoring=True)
    rows = {(r["run_date"].day, r["column"]): r["severity"] for r in store.read("drift_log").collect()}
    assert set(rows) == {(d, c) for d in (2, 3, 4) for c in ("f", "p")}  # day 1 has nothing before it
    assert rows[(2, "p")] == "critical" and rows[(4, "p")] != "none"
    texts = [(r["run_date"].day, r["severity"], r["message"]) for r in store.read("alert_log").collect()]
    assert any(d == 4 and s == "warn" and "p: drift on 3 of the last runs" in m for d, s, m in texts)
    assert not any(d < 4 and s == "warn" for d, s, m in texts)


def test_backfill_isolates_days(spark, store):
    batch = days(spark, {1: [1, 2], 2: [99], 4: [3], 5: [4]})
    out = jobs.backfill(spark, store, PROJECT, SCORER, "2024-01-01", "2024-01-04", batch)
    got = {r["run_date"].day: (r["status"], r["row_count"], r["error_message"]) for r in out.collect()}
    assert got[1] == ("success", 2, None) and got[4] == ("success", 1, None) and 5 not in got
    assert got[2][:2] == ("failed", 0) and "outside range" in got[2][2]
    assert got[3][:2] == ("failed", 0) and "empty" in got[3][2]
    assert saved(store) == [(1, 0.1), (1, 0.2), (4, 0.3)]
    assert [e[:3] for e in log(store)] == [(1, "success", 2), (2, "failed", 0), (3, "failed", 0), (4, "success", 1)]


def test_backfill_again_skips_and_replace_overwrites(spark, store):
    jobs.backfill(spark, store, PROJECT, SCORER, "2024-01-01", "2024-01-02", days(spark, {1: [1], 2: [2]}))
    again = jobs.backfill(spark, store, PROJECT, SCORER, "2024-01-01", "2024-01-03", days(spark, {1: [5], 2: [5], 3: [5]}))
    assert {r["run_date"].day: r["status"] for r in again.collect()} == {1: "skipped", 2: "skipped", 3: "success"}
    assert saved(store) == [(1, 0.1), (2, 0.2), (3, 0.5)]
    jobs.backfill(spark, store, PROJECT, SCORER, "2024-01-02", "2024-01-02", days(spark, {2: [7]}), replace=True)
    assert saved(store) == [(1, 0.1), (2, 0.7), (3, 0.5)]


def test_backfill_with_missing_columns_and_empty_range(spark, store):
    batch = days(spark, {1: [1]}).drop("f")
    out = jobs.backfill(spark, store, PROJECT, SCORER, "2024-01-01", "2024-01-02", batch).collect()
    got = {r["run_date"].day: r["error_message"] for r in out}
    assert "Missing feature_columns" in got[1] and "empty" in got[2]
    assert jobs.backfill(spark, store, PROJECT, SCORER, "2024-01-03", "2024-01-02", days(spark, {1: [1]})).count() == 0


def test_backfill_with_a_python_scorer(spark, store):
    scorer = batch_scorer(lambda: 10.0, lambda m, x: x["f"] / m, COLUMNS, carry=["run_date"])
    jobs.backfill(spark, store, PROJECT, scorer, "2024-01-01", "2024-01-02", days(spark, {1: [1], 2: [2]}))
    assert saved(store) == [(1, 0.1), (2, 0.2)]


def test_backfill_of_dated_files(spark, store, tmp_path):
    for d, v in ((1, 1), (3, 3)):
        (tmp_path / f"b_2024-01-0{d}.csv").write_text(f"id,f\na,{v}\n")
    project = replace(PROJECT, input=SourceSpec("file", {"path": str(tmp_path / "b_{run_date}.csv")}))
    out = jobs.backfill(spark, store, project, SCORER, "2024-01-01", "2024-01-03").collect()
    got = {r["run_date"].day: (r["status"], r["row_count"]) for r in out}
    assert got == {1: ("success", 1), 2: ("failed", 0), 3: ("success", 1)}


def test_backfill_reads_only_the_range(spark, tmp_path):
    days(spark, {1: [1], 2: [2]}).write.partitionBy("run_date").parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    narrowed = df.filter(F.col("run_date").cast("date").between(F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 1))))
    assert "PartitionFilters: [isnotnull(run_date" in narrowed._jdf.queryExecution().executedPlan().toString()


def test_run_active_projects(spark, store):
    registry = spark.createDataFrame([("b", "active"), ("a", "active"), ("_x", "active"), ("c", "paused")],
                                     "project_id string, status string")
    seen = []

    def run(spark, store, project, scorer, run_date):
        seen.append(project)
        if project == "B":
            raise ValueError("bad")
        return "success"

    got = jobs.run_active(spark, store, {"a": "A", "b": "B"}, registry, {"a": None, "b": None}, "2024-01-01", run)
    assert seen == ["A", "B"] and got == {"a": "success", "b": "bad"}


def test_dry_run_writes_nothing(spark, store):
    scored, preview, stats = jobs.dry_run(spark, PROJECT, SCORER, "2024-01-01", days(spark, {1: range(1, 10)}))
    assert scored.count() == 9 and preview.count() == 9
    r = stats.head()
    assert (r["column"], r["min"], r["max"], r["null_count"]) == ("p", 0.1, 0.9, 0)
    with pytest.raises(QualityError):
        jobs.dry_run(spark, PROJECT, SCORER, "2024-01-01", days(spark, {1: [20]}))


def test_preflight(spark):
    good = days(spark, {1: [1]})
    assert jobs.preflight(spark, PROJECT, SCORER, "2024-01-01", good) == []
    assert "is empty" in jobs.preflight(spark, PROJECT, SCORER, "2024-01-01", good.limit(0))[0]
    assert "the input lacks ['f']" in jobs.preflight(spark, PROJECT, SCORER, "2024-01-01", good.drop("f"))
    assert "trial scoring" in jobs.preflight(spark, PROJECT, SCORER, "2024-01-01", days(spark, {1: [99]}))[0]
    orphan = replace(PROJECT, evaluation=EvalSpec(("mse",), {"r2": 0.5}))
    assert "r2" in jobs.preflight(spark, orphan, SCORER, "2024-01-01", good)[0]
    absent = replace(PROJECT, input=SourceSpec("file", {"path": "/nonexistent/x.csv"}))
    assert "cannot be read" in jobs.preflight(spark, absent, SCORER)[0]


def test_backfill_with_a_scorer_that_raises_on_one_day(spark, store):
    def predict(model, x):
        if (x["f"] == 7).any():
            raise RuntimeError("seven")
        return x["f"] / model

    scorer = batch_scorer(lambda: 10.0, predict, COLUMNS, carry=["run_date"])
    with pytest.warns(UserWarning, match="day by day"):
        out = jobs.backfill(spark, store, PROJECT, scorer, "2024-01-01", "2024-01-03", days(spark, {1: [1], 2: [7], 3: [3]}))
    got = {r["run_date"].day: (r["status"], r["row_count"]) for r in out.collect()}
    assert got == {1: ("success", 1), 2: ("failed", 0), 3: ("success", 1)}
    assert saved(store) == [(1, 0.1), (3, 0.3)]
    assert [e[:3] for e in log(store)] == [(1, "success", 1), (2, "failed", 0), (3, "success", 1)]
