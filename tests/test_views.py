from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest

from batchgauge.operators import lookups, views

LOG = "project_id string, run_date date, status string, row_count long, created_at timestamp"


@pytest.fixture
def log(spark):
    rows = [("a", date(2024, 1, d), "success", d, datetime(2024, 1, d, h)) for d in (1, 2, 3) for h in (1, 5)]
    rows += [("b", date(2024, 1, 9), "failed", 0, datetime(2024, 1, 9)), ("b", date(2024, 1, 8), "success", 7, datetime(2024, 2, 1))]
    return spark.createDataFrame(rows, LOG)


def test_run_history(log):
    got = views.run_history(log, "a", 3).collect()
    assert [(r["run_date"].day, r["created_at"].hour) for r in got] == [(3, 5), (3, 1), (2, 5)]


def test_latest_run(log):
    got = {r["project_id"]: (r["run_date"].day, r["created_at"]) for r in views.latest_run(log).collect()}
    assert got == {"a": (3, datetime(2024, 1, 3, 5)), "b": (9, datetime(2024, 1, 9))}
    newest = {r["project_id"]: r["run_date"].day for r in views.latest_run(log, by_creation=True).collect()}
    assert newest == {"a": 3, "b": 8}
    assert views.latest_run(log).columns == log.columns


def test_check_views(spark):
    rows = [("a", date(2024, 1, d), c, True, float(d), 1.0, datetime(2024, 1, d)) for d in (1, 2) for c in ("y", "x")]
    checks = spark.createDataFrame(rows, "project_id string, run_date date, check_name string, passed boolean, value double, threshold double, created_at timestamp")
    assert [(r["run_date"].day, r["check_name"]) for r in views.check_history(checks, "a", 3).collect()] == [(2, "x"), (2, "y"), (1, "x")]
    assert {(r["run_date"].day, r["check_name"]) for r in views.latest_checks(checks).collect()} == {(2, "x"), (2, "y")}
    assert [r["value"] for r in views.check_trend(checks, "a", "y").collect()] == [1.0, 2.0]
    assert {r[0] for r in views.check_names(checks).collect()} == {"x", "y"}


def test_predictions(spark):
    df = spark.createDataFrame([(i, 0.5, date(2024, 1, 1 + i % 3)) for i in range(30)], "id int, p double, run_date date")
    assert [r["id"] for r in views.recent_predictions(df, ["id"], 4).collect()] == [2, 5, 8, 11]
    assert [r["id"] for r in views.predictions_of(df, "2024-01-01", ["id"], 2).collect()] == [0, 3]


def plot_counts(values, bins):
    """Equal-width right-closed bins with the lowest value included."""
    s = pd.Series(values).dropna()
    return s.value_counts(bins=bins, sort=False).tolist()


@pytest.mark.parametrize("values", [
    np.random.default_rng(1).normal(size=500).tolist(), list(range(31)), [5.0] * 7, [0.0] * 3, [1.0, None, float("nan"), 9.0], [-2.0, 2.0],
])
def test_histogram(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    got = views.histogram(df, ["x"]).orderBy("bin").collect()
    assert len(got) == 30 and [r["bin"] for r in got] == list(range(1, 31))
    assert [r["n"] for r in got] == plot_counts(values, 30)


def test_first_rows_small_and_large(spark):
    df = spark.range(5000).selectExpr("5000 - id AS k", "id AS v").repartition(9)
    for n in (10, 1500, 9999):
        got = [r["k"] for r in views.first_rows(df, n, ["k"]).collect()]
        assert got == list(range(1, min(n, 5000) + 1))
    assert views.first_rows(df, 1500, ["k"]).columns == ["k", "v"]


def test_first_rows_with_ties_nulls_and_nan(spark):
    rows = [(None, i) for i in range(500)] + [(float(i // 700), i) for i in range(3000)] + [(float("nan"), i) for i in range(90)]
    df = spark.createDataFrame(rows, "k double, v int").repartition(7)
    rank = lambda k: (0, 0.0) if k is None else (2, 0.0) if k != k else (1, k)
    want = sorted(rows, key=lambda r: (rank(r[0]), r[1]))
    for n in (1200, 2001, 3550):
        got = [(r["k"], r["v"]) for r in views.first_rows(df, n, ["k", "v"]).collect()]
        assert [(rank(k), v) for k, v in got] == [(rank(k), v) for k, v in want[:n]]


def test_top_rows_break_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "n string, v double")
    assert [r["n"] for r in views.top_rows(df, "v", 2, "n").collect()] == ["c", "a"]


def test_labels_by_lag(spark):
    scored = spark.createDataFrame([(1, 0.5, date(2024, 1, 1)), (2, 0.6, date(2024, 1, 1)), (1, 0.7, date(2024, 1, 2))],
                                   "id int, p double, run_date date")
    labels = spark.createDataFrame([(1, 1, date(2024, 1, 15)), (2, 0, date(2024, 1, 16))], "id int, bad int, label_date date")
    got = lookups.join_labels(scored, labels, ["id"], "bad", 14).collect()
    assert [(r["id"], r["run_date"].day, r["bad"], r["p"]) for r in got] == [(1, 1, 1, 0.5)]


def test_model_names(spark):
    versions = spark.createDataFrame([("m", 1, ["Production"]), ("m", 2, ["Candidate", "Best"]), ("n", 1, [])],
                                     "name string, version int, aliases array<string>")
    asked = spark.createDataFrame([("m", "Production"), ("m", "Best"), ("m", "2"), ("n", "Production"), ("m", "9"), ("n", "1")],
                                  "name string, version string")
    got = {(r["name"], r["version"]): r["resolved_version"] for r in lookups.resolve_models(asked, versions).collect()}
    assert got == {("m", "Production"): 1, ("m", "Best"): 2, ("m", "2"): 2, ("n", "Production"): None, ("m", "9"): None, ("n", "1"): 1}


def test_active_projects(spark):
    df = spark.createDataFrame([("b", "active"), ("a", "active"), ("_t", "active"), ("c", "off")], "project_id string, status string")
    assert [r[0] for r in lookups.active_projects(df).collect()] == ["a", "b"]
