import math

import numpy as np
import pytest

from batchgauge.config import METRIC_NAMES
from batchgauge.operators import metrics

Y = [1, 0, 0, 1, 1, 0, 0, 1, 0, 1]
PRED = [1, 0, 1, 1, 0, 0, 0, 1, 0, 1]
PROBA = [.72, .12, .57, .93, .41, .33, .24, .66, .08, .88]


def frame(spark, y, pred, proba):
    rows = [(None if a is None else int(a), None if b is None else int(b), None if c is None else float(c))
            for a, b, c in zip(y, pred, proba)]
    return spark.createDataFrame(rows, "y int, pred int, p double").repartition(3)


def brute_auc(y, p):
    pos = [s for t, s in zip(y, p) if t == 1]
    neg = [s for t, s in zip(y, p) if t == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ks(y, p):
    pos = np.array([s for t, s in zip(y, p) if t == 1])
    neg = np.array([s for t, s in zip(y, p) if t == 0])
    return max(abs((pos <= x).mean() - (neg <= x).mean()) for x in p)


def values(df, names, **kw):
    return {r["metric"]: r["value"] for r in metrics.evaluate(df, names, "y", "pred", "p", **kw).collect()}


def test_fixed_sample(spark):
    got = values(frame(spark, Y, PRED, PROBA), METRIC_NAMES)
    loss = -np.mean([math.log(p if t else 1 - p) for t, p in zip(Y, PROBA)])
    want = {
        "auc_roc": brute_auc(Y, PROBA), "accuracy": 0.8, "f1_macro": 0.8, "f1_weighted": 0.8,
        "precision_macro": 0.8, "recall_macro": 0.8, "log_loss": loss, "ks_statistic": brute_ks(Y, PROBA),
        "gini": 2 * brute_auc(Y, PROBA) - 1, "mse": 0.2, "rmse": math.sqrt(0.2), "r2": 0.2, "mae": 0.2,
    }
    assert set(got) == set(METRIC_NAMES)
    for name, v in want.items():
        assert got[name] == pytest.approx(v, abs=1e-6), name


def test_ranking_with_many_ties_and_a_hot_score(spark):
    rng = np.random.default_rng(11)
    p = np.concatenate([np.full(700, 0.4), rng.integers(0, 30, 700) / 30, rng.random(600)])
    y = (rng.random(2000) < 0.2 + 0.6 * p).astype(int)
    got = metrics.ranked_metrics(frame(spark, y, y, p), "y", "p").head()
    assert got["auc_roc"] == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert got["ks_statistic"] == pytest.approx(brute_ks(y, p), abs=1e-12)


def test_ranking_by_group_with_a_null_group(spark):
    rows = [(g, t, s) for g in ("a", None) for t, s in zip(Y, PROBA if g else PROBA[::-1])]
    df = spark.createDataFrame(rows, "g string, y int, p double")
    got = {r["g"]: r["auc_roc"] for r in metrics.ranked_metrics(df, "y", "p", ["g"]).collect()}
    assert got["a"] == pytest.approx(brute_auc(Y, PROBA)) and got[None] == pytest.approx(brute_auc(Y, PROBA[::-1]))


def test_single_class(spark):
    got = values(frame(spark, [1, 1], [1, 1], [.5, .6]), ["auc_roc", "gini", "ks_statistic", "log_loss", "accuracy"])
    assert got == {"auc_roc": None, "gini": None, "ks_statistic": 0.0, "log_loss": None, "accuracy": 1.0}


def test_empty_batch_fails_every_metric_but_ks(spark):
    got = values(frame(spark, [], [], []), METRIC_NAMES)
    assert {k for k, v in got.items() if v is not None} == {"ks_statistic"} and len(got) == 13


def test_missing_inputs_fail_what_needs_them(spark):
    df = frame(spark, [0, 1, 1], [0, None, 1], [.1, .5, .9])
    got = values(df, ["accuracy", "f1_macro", "mse", "auc_roc"])
    assert got == {"accuracy": None, "f1_macro": None, "mse": None, "auc_roc": 1.0}
    df = frame(spark, [0, 1, 1], [0, 1, 1], [.1, float("nan"), .9])
    assert values(df, ["auc_roc", "ks_statistic", "log_loss"]) == {"auc_roc": None, "ks_statistic": None, "log_loss": None}
    df = frame(spark, [0, None, 1], [0, 1, 1], [.1, .3, .9])
    assert values(df, ["auc_roc", "accuracy"]) == {"auc_roc": None, "accuracy": None}


def test_scores_needed(spark):
    df = frame(spark, Y, PRED, PROBA)
    got = {r["metric"]: r["value"] for r in metrics.evaluate(df, ["auc_roc", "accuracy", "log_loss", "gini"], "y", "pred").collect()}
    assert got == {"auc_roc": None, "accuracy": 0.8, "log_loss": None, "gini": None}


def test_log_loss_is_clipped(spark):
    got = values(frame(spark, [0, 1], [0, 1], [1.0, 1.0]), ["log_loss"])["log_loss"]
    assert got == pytest.approx(-math.log(2.220446049250313e-16) / 2, abs=1e-6)


def test_regression_on_large_values_and_constant_truth(spark):
    y = [1e9 + i for i in range(10)]
    rows = [(t, t + (1 if i % 2 else -1)) for i, t in enumerate(y)]
    df = spark.createDataFrame(rows, "y double, pred double")
    got = metrics.pointwise_metrics(df, "y", "pred", None, ["mse", "rmse", "r2", "mae"]).head()
    assert got["r2"] == pytest.approx(1 - 1 / np.var(np.arange(10)), abs=1e-9) and got["mse"] == 1.0
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, pred double")
    assert metrics.pointwise_metrics(flat, "y", "pred", None, ["r2"]).head()["r2"] == 0.0
    same = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, pred double")
    assert metrics.pointwise_metrics(same, "y", "pred", None, ["r2"]).head()["r2"] == 1.0


def multiclass(spark, n=400):
    rng = np.random.default_rng(2)
    raw = rng.random((n, 3)) + 0.05
    p = raw / raw.sum(axis=1, keepdims=True)
    y = [int(np.argmax(r + rng.random(3) * 0.4)) for r in p]
    pred = p.argmax(axis=1)
    rows = [(t, int(q), *map(float, r)) for t, q, r in zip(y, pred, p)]
    return y, pred, p, spark.createDataFrame(rows, "y int, pred int, p0 double, p1 double, p2 double")


def test_multiclass(spark):
    y, pred, p, df = multiclass(spark)
    scores = {0: "p0", 1: "p1", 2: "p2"}
    got = {r["metric"]: r["value"] for r in
           metrics.evaluate(df, ["auc_roc", "gini", "ks_statistic", "log_loss", "f1_macro", "f1_weighted"], "y", "pred", scores).collect()}
    auc = np.mean([brute_auc([int(t == k) for t in y], p[:, k]) for k in range(3)])
    assert got["auc_roc"] == pytest.approx(auc, abs=1e-6) and got["gini"] == pytest.approx(2 * auc - 1, abs=1e-6)
    assert got["log_loss"] == pytest.approx(-np.mean([math.log(p[i, t]) for i, t in enumerate(y)]), abs=1e-6)
    both = [(t, s) for t, s in zip(y, p[:, 1]) if t in (0, 1)]
    assert got["ks_statistic"] == pytest.approx(brute_ks(*zip(*both)), abs=1e-6)
    f1, support = [], []
    for k in range(3):
        tp = sum(a == k == b for a, b in zip(y, pred))
        n_true, n_pred = y.count(k), list(pred).count(k)
        f1.append(2 * tp / (n_true + n_pred))
        support.append(n_true)
    assert got["f1_macro"] == pytest.approx(np.mean(f1), abs=1e-6)
    assert got["f1_weighted"] == pytest.approx(np.average(f1, weights=support), abs=1e-6)


def test_multiclass_auc_needs_scores_that_add_up(spark):
    df = spark.createDataFrame([(0, .5, .6, .1), (1, .2, .6, .2), (2, .1, .1, .8)], "y int, p0 double, p1 double, p2 double")
    assert metrics.one_vs_rest_auc(df, "y", {0: "p0", 1: "p1", 2: "p2"}).head()["auc_roc"] is None


def test_two_score_columns_use_the_second(spark):
    rows = [(t, q, 1 - s, s) for t, q, s in zip(Y, PRED, PROBA)]
    df = spark.createDataFrame(rows, "y int, pred int, p0 double, p1 double")
    got = {r["metric"]: r["value"] for r in metrics.evaluate(df, ["auc_roc", "ks_statistic"], "y", "pred", {0: "p0", 1: "p1"}).collect()}
    assert got["auc_roc"] == pytest.approx(brute_auc(Y, PROBA), abs=1e-6) and got["ks_statistic"] == pytest.approx(brute_ks(Y, PROBA), abs=1e-6)


def test_label_never_predicted_scores_zero(spark):
    df = frame(spark, [0, 0, 1, 2], [0, 0, 0, 0], [.1] * 4)
    got = {r["label"]: (r["precision"], r["recall"], r["f1"]) for r in
           metrics.label_scores(metrics.confusion_counts(df, "y", "pred")).collect()}
    assert got["1"] == (0.0, 0.0, 0.0) and got["0"] == (0.5, 1.0, pytest.approx(2 / 3))


def test_thresholds_both_directions_and_failures(spark):
    results = metrics.evaluate(frame(spark, Y, PRED, PROBA), ["accuracy", "log_loss"], "y", "pred", "p")
    checks = metrics.threshold_checks(results, {"accuracy": 0.8, "log_loss": 5.0, "r2": 0.1, "mae": 0.1}).collect()
    got = {r["metric"]: (r["passed"], r["reason"]) for r in checks}
    failed = "metric computation failed"
    assert got == {"accuracy": (True, None), "log_loss": (True, None), "r2": (False, failed), "mae": (False, failed)}
    strict = metrics.threshold_checks(results, {"accuracy": 0.99, "log_loss": 0.01}).collect()
    assert [r["passed"] for r in strict] == [False, False] and all(r["reason"] is None for r in strict)


def test_nan_metric_fails_its_threshold(spark):
    results = spark.createDataFrame([(1, "auc_roc", float("nan"))], "seq int, metric string, value double")
    assert metrics.threshold_checks(results, {"auc_roc": 0.1}).head()["passed"] is False


def test_summary_lines(spark):
    results = metrics.evaluate(frame(spark, Y, PRED, PROBA), ["accuracy", "auc_roc", "mae", "r2"], "y", None, "p")
    text = metrics.metric_summary(results, {"auc_roc": 0.5, "mae": 0.3}).head()["summary"]
    assert text.split("\n") == [
        "  ℹ️  accuracy: FAILED", "  ✅ auc_roc: 0.9600 (threshold: 0.5)", "  ❌ mae: FAILED (threshold: 0.3)", "  ℹ️  r2: FAILED",
    ]


def test_unknown_metric(spark):
    with pytest.raises(ValueError, match="no metric is called"):
        metrics.evaluate(frame(spark, Y, PRED, PROBA), ["nope"], "y", "pred", "p")
    assert metrics.evaluate(frame(spark, Y, PRED, PROBA), [], "y", "pred", "p").count() == 0


def test_versions_side_by_side(spark):
    rows = [(t, s, 1 - s) for t, s in zip(Y, PROBA)]
    df = spark.createDataFrame(rows, "y int, old double, new double")
    got = metrics.compare_versions(df, {"candidate": "new", "production": "old"}, ["auc_roc"], "y").head()
    assert got["production"] == pytest.approx(0.96) and got["delta"] == pytest.approx(0.04 - 0.96)


RANKS = ["auc_roc", "gini", "ks_statistic", "log_loss"]


def ranks(df, by=()):
    return {tuple(r[b] for b in by) + (r["metric"],): r["value"] for r in metrics.evaluate(df, RANKS, "y", None, "p", by).collect()}


@pytest.mark.parametrize("kind, low, high", [("string", "bad", "good"), ("int", 1, 2), ("int", -1, 1), ("double", 0.5, 3.0)])
def test_any_two_labels_rank_with_the_greater_as_positive(spark, kind, low, high):
    rows = [(high if t else low, p) for t, p in zip(Y, PROBA)]
    got = ranks(spark.createDataFrame(rows, f"y {kind}, p double"))
    loss = -np.mean([math.log(p if t else 1 - p) for t, p in zip(Y, PROBA)])
    assert got[("auc_roc",)] == pytest.approx(brute_auc(Y, PROBA), abs=1e-6)
    assert got[("gini",)] == pytest.approx(2 * brute_auc(Y, PROBA) - 1, abs=2e-6)
    assert got[("log_loss",)] == pytest.approx(loss, abs=1e-6)
    if kind == "string":
        assert got[("ks_statistic",)] == 0.0


def test_text_labels_by_group_and_with_missing_or_third_labels(spark):
    rows = [(g, "b" if t else "a", p) for g in ("x", None) for t, p in zip(Y, PROBA)]
    rows += [("gap", None, 0.5), ("gap", "a", 0.1), ("gap", "b", 0.9)]
    rows += [("three", c, 0.5) for c in "abc"]
    got = ranks(spark.createDataFrame(rows, "g string, y string, p double"), ["g"])
    for g in ("x", None):
        assert got[(g, "auc_roc")] == pytest.approx(brute_auc(Y, PROBA), abs=1e-6)
    assert got[("gap", "auc_roc")] is None and got[("three", "auc_roc")] is None and got[("three", "log_loss")] is None


def test_text_truth_never_equals_a_number(spark):
    df = spark.createDataFrame([("1", 1), ("a", 0)], "y string, pred int")
    assert metrics.evaluate(df, ["accuracy"], "y", "pred").first()["value"] == 0.0


def test_one_score_column_in_a_mapping_ranks_nothing(spark):
    df = frame(spark, Y, PRED, PROBA)
    rows = metrics.evaluate(df, ["auc_roc", "ks_statistic", "accuracy"], "y", "pred", {1: "p"}).collect()
    got = {r["metric"]: r["value"] for r in rows}
    assert got["auc_roc"] is None and got["ks_statistic"] is None and got["accuracy"] == 0.8


def test_text_truth_with_number_predictions_fails_the_metric_only(spark):
    df = spark.createDataFrame([("yes", 1, 0.9), ("no", 0, 0.2), ("no", 1, 0.6)], "y string, pred int, p double")
    got = values(df, ["f1_macro", "recall_macro", "accuracy", "auc_roc"])
    assert got == {"f1_macro": None, "recall_macro": None, "accuracy": 0.0, "auc_roc": 1.0}


def test_added_metric(spark):
    from pyspark.sql import functions as F

    from batchgauge.config import ADDED_METRICS, add_metric

    add_metric("hit_rate", lambda y_true, y_pred, y_proba: F.avg((F.col(y_true) == F.col(y_pred)).cast("int")))
    try:
        assert values(frame(spark, Y, PRED, PROBA), ["hit_rate", "mse"]) == {"hit_rate": 0.8, "mse": 0.2}
        results = metrics.evaluate(frame(spark, Y, PRED, PROBA), ["hit_rate"], "y", "pred", "p")
        assert metrics.threshold_checks(results, {"hit_rate": 0.9}).head()["passed"] is False
    finally:
        del ADDED_METRICS["hit_rate"]
    with pytest.raises(ValueError, match="built-in"):
        add_metric("mse", lambda *names: None)
