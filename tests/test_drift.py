from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchgauge.config import DriftSpec
from batchgauge.operators import alerts, drift

ON = DriftSpec(enabled=True)


def numpy_psi(reference, current, bins=10):
    """Brute force: edges from reference deciles, open ends, shares plus 1e-4."""
    reference = np.array([x for x in reference if x is not None and not np.isnan(x)])
    current = np.array([x for x in current if x is not None and not np.isnan(x)])
    if not len(reference) or not len(current):
        return 0.0
    inner = np.unique(np.percentile(reference, [100 * i / bins for i in range(1, bins)]))
    def shares(x):
        at = (x[:, None] >= inner[None, :]).sum(axis=1)
        return np.bincount(at, minlength=len(inner) + 1) / len(x) + 1e-4
    r, c = shares(reference), shares(current)
    return float(np.sum((c - r) * np.log(c / r)))


def frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def one(spark, reference, current, **kw):
    rows = drift.psi(frame(spark, reference), frame(spark, current), ["x"], **kw).collect()
    assert len(rows) == 1
    return rows[0]["psi"]


def normal(seed, mean=0.0, n=1000):
    return np.random.default_rng(seed).normal(mean, 1, n)


def test_identical_is_near_zero(spark):
    assert one(spark, normal(1), normal(1)) < 0.01


def test_shift_is_large(spark):
    got = one(spark, normal(1), normal(2, 3.0))
    assert got > 0.25
    assert got == pytest.approx(numpy_psi(normal(1), normal(2, 3.0)), abs=1e-12)


@pytest.mark.parametrize("reference, current", [
    ([], [1.0, 2.0]), ([1.0, 2.0], []), ([], []), ([None, float("nan")], [1.0]), ([1.0], [None]),
])
def test_empty_side_is_zero(spark, reference, current):
    assert one(spark, reference, current) == 0.0


@pytest.mark.parametrize("reference, current", [
    ([1, 2, float("nan"), 4, 5], [1, 2, 3, 4, 5]),
    ([5] * 20, [5] * 10 + [4] * 3),             # constant reference: two bins
    ([0] * 90 + [1] * 10, [0] * 50 + [1] * 50),  # repeated edges
    (list(range(100)), [1000.0]),                # empty bins count on both sides
])
def test_special_shapes(spark, reference, current):
    assert one(spark, reference, current) == pytest.approx(numpy_psi(reference, current), abs=1e-12)


def test_sketched_bins_are_close(spark):
    got = one(spark, normal(1), normal(2, 0.3), approximate=True)
    assert got == pytest.approx(numpy_psi(normal(1), normal(2, 0.3)), abs=0.02)


def test_several_groups_share_a_reference(spark):
    ref, cur = normal(1), {1: normal(2, 0.5), 2: normal(3), 3: np.array([np.nan])}
    rows = [(d, float(v)) for d, vs in cur.items() for v in vs]
    current = spark.createDataFrame(rows, "d int, x double")
    got = {r["d"]: r["psi"] for r in drift.psi(frame(spark, ref), current, ["x"], by=["d"]).collect()}
    for d, vs in cur.items():
        assert got[d] == pytest.approx(numpy_psi(ref, vs), abs=1e-12)


@pytest.mark.parametrize("value, tier", [(0.05, "none"), (0.10, "warn"), (0.20, "warn"), (0.25, "critical"), (0.50, "critical")])
def test_severity_bounds(spark, value, tier):
    assert spark.range(1).select(drift.severity(F.lit(value))).head()[0] == tier


def test_severity_uses_the_unrounded_value(spark):
    rows = spark.createDataFrame([("a", 0.09996), ("b", 0.1)], "column string, psi double")
    got = {r["column"]: (r["psi"], r["severity"], r["message"]) for r in drift.graded(rows, ON).collect()}
    assert got == {"a": (0.1, "none", "PSI=0.1000 (none)"), "b": (0.1, "warn", "PSI=0.1000 (warn)")}


def test_check_skips_absent_and_text_columns_and_can_be_off(spark):
    cur = spark.createDataFrame([(1.0, "a", 2)], "x double, s string, k int")
    ref = spark.createDataFrame([(1.0, "a")], "x double, s string")
    assert [r["column"] for r in drift.drift_check(cur, ref, ["x", "s", "k", "zz"], ON).collect()] == ["x"]
    off = drift.drift_check(cur, ref, ["x"], DriftSpec())
    assert off.columns == ["column", "psi", "severity", "message"] and off.count() == 0


def dated(spark, days=40, n=50):
    rng = np.random.default_rng(5)
    rows = [(date(2024, 1, 1) + timedelta(days=d), float(v)) for d in range(days) for v in rng.normal(d * 0.05, 1, n)]
    return rows, spark.createDataFrame(rows, "run_date date, x double")


def test_reference_window_ends_the_day_before(spark):
    rows, df = dated(spark)
    got = drift.reference_window(df, "2024-02-05", 30).agg(F.min("run_date"), F.max("run_date"), F.count("*")).head()
    assert tuple(got) == (date(2024, 1, 6), date(2024, 2, 4), 30 * 50)


def test_rolling_drift_per_date(spark):
    rows, df = dated(spark)
    asked = [date(2024, 1, 1), date(2024, 1, 20), date(2024, 2, 5)]
    got = {r["run_date"]: r["psi"] for r in drift.rolling_drift(df, ["x"], asked, DriftSpec(enabled=True, reference="last_7_days")).collect()}
    for d in asked:
        ref = [v for day, v in rows if d - timedelta(days=7) <= day < d]
        assert got[d] == pytest.approx(numpy_psi(ref, [v for day, v in rows if day == d]), abs=5.1e-5)


def test_sustained(spark):
    tiers = ["warn", "none", "critical", "none", "warn", "none", "none", "none"]
    rows = [("p", "x", date(2024, 1, i + 1), t) for i, t in enumerate(tiers)]
    df = spark.createDataFrame(rows, "project_id string, column string, run_date date, severity string")
    got = drift.sustained_drift(df).orderBy("run_date").collect()
    assert [r["drifted_days"] for r in got] == [1, 1, 2, 2, 3, 2, 2, 1]
    assert [r["sustained"] for r in got] == [False] * 4 + [True] + [False] * 3


def test_immediate_tier(spark):
    report = spark.createDataFrame(
        [("p", date(2024, 1, 1), "null_outputs", False, "m1"), ("p", date(2024, 1, 1), "range_a", True, "m2")],
        "project_id string, run_date date, check_name string, passed boolean, message string",
    )
    drifted = spark.createDataFrame(
        [("p", date(2024, 1, 1), "x", "critical", "d1"), ("p", date(2024, 1, 1), "y", "warn", "d2")],
        "project_id string, run_date date, column string, severity string, message string",
    )
    got = {(r["source"], r["name"]) for r in alerts.immediate_alerts(report, drifted).collect()}
    assert got == {("check", "null_outputs"), ("drift", "x")}
