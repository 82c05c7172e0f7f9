from dataclasses import replace
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchgauge.config import (
    CheckSpec, ColumnSpec, DriftSpec, EvalSpec, GroundTruthSpec, ModelRef, OutputSpec, Project, SourceSpec,
    add_ranked_metric,
)
from batchgauge.operators import drift, metrics, profiles, sinks, truth
from batchgauge.operators.scoring import expression_scorer
from batchgauge.plans import jobs
from batchgauge.sources import readers

PROJECT = Project(
    "p", model=ModelRef("p"), schema=ColumnSpec(("id",), ("f", "g"), ("s",)), output=OutputSpec("r.s", "replace_date"),
    monitoring=CheckSpec(null_output_max_pct=100.0, row_count_change_max_pct=1000.0, drift=DriftSpec(enabled=True)),
)
SCORER = expression_scorer(lambda: {"s": F.col("f") / 10})


def day_rows(spark, values, text="x"):
    return spark.createDataFrame([(f"i{i}", None if v is None else float(v), text) for i, v in enumerate(values)], "id string, f double, g string")


@pytest.mark.parametrize("value, low", [
    (0.0, 0.0), (-0.0, 0.0), (1.0, 1.0), (1.99, 1.984375), (2.0, 2.0), (-1.0, -1.0), (-1.001, -1.0078125), (1e-310, 0.0), (8.0, 8.0),
    (float("inf"), float("inf")), (None, None), (1e300, None),
])
def test_cells(spark, value, low):
    got = spark.createDataFrame([(value,)], "v double").select(profiles.cell_of(F.col("v"))).first()[0]
    if value == 1e300:
        assert 0.99 * value < got <= value
    else:
        assert got == low


def test_cells_are_in_order_and_narrow(spark):
    values = np.concatenate((np.random.default_rng(0).normal(0, 1e3, 2000), 2.0 ** np.arange(-60, 60), 2.0 ** np.arange(-60, 60) * (1 - 1e-16)))
    got = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", profiles.cell_of(F.col("v")).alias("c")).toPandas().sort_values("v")
    assert got.c.is_monotonic_increasing and (got.c <= got.v).all()
    assert ((got.v - got.c).abs() <= 0.016 * got.v.abs() + 1e-300).all()


def test_features_drift_from_the_log_and_a_rerun_counts_once(spark, store):
    start, rng = date(2024, 1, 1), np.random.default_rng(5)
    for k in range(4):
        jobs.daily_run(spark, store, PROJECT, SCORER, start + timedelta(days=k), day_rows(spark, rng.normal(10 + 8 * (k == 3), 1, 300)), with_monitoring=True)
    log = store.read("feature_log").filter("column = 'f'")
    assert {r["run_date"].day: r["n"] for r in log.groupBy("run_date").agg(F.sum("n").alias("n")).collect()} == {1: 300, 2: 300, 3: 300, 4: 300}
    assert store.read("feature_log").filter("column = 'g'").isEmpty()  # text has no cells
    found = {(r["run_date"].day, r["column"]): r["severity"] for r in store.read("drift_log").collect()}
    assert set(found) == {(d, c) for d in (2, 3, 4) for c in ("f", "s")} and found[(4, "f")] == found[(4, "s")] == "critical"
    alerts = store.read("alert_log").filter("run_date = '2024-01-04'").count()
    jobs.daily_run(spark, store, PROJECT, SCORER, "2024-01-04", day_rows(spark, rng.normal(10, 1, 300)), with_monitoring=True)
    latest = profiles.latest_rows(store.read("drift_log"), ["run_date"]).filter("run_date = '2024-01-04'").collect()
    assert {r["column"]: r["severity"] == "critical" for r in latest} == {"f": False, "s": False}
    assert alerts > 0 and profiles.latest_rows(store.read("alert_log"), ["run_date"]).filter("run_date = '2024-01-04'").count() in (0, alerts)


def test_log_drift_is_near_exact_drift(spark, store):
    rng = np.random.default_rng(2)
    old, new = rng.lognormal(0, 1, 3000), rng.lognormal(0.5, 1, 3000)
    for day, values in ((1, old), (2, new)):
        profiles.log_features(store, PROJECT, day_rows(spark, values), F.lit(datetime(2024, 1, day)), F.lit(date(2024, 1, day)))
    rows = profiles.drift_from_log(store.read("feature_log"), PROJECT, [date(2024, 1, 2)], ["f"], DriftSpec(enabled=True)).collect()
    exact = drift.psi(day_rows(spark, old), day_rows(spark, new), ["f"]).first()["psi"]
    assert len(rows) == 1 and rows[0]["psi"] == pytest.approx(exact, rel=0.1)


def test_profiles_can_be_stored(spark, store):
    old, new = np.arange(100.0), np.arange(50.0, 150.0)
    table = drift.profile_rows(spark, drift.reference_profile(day_rows(spark, old), ["f"]))
    table.write.parquet(store.path("profiles"))
    found = drift.psi_against(drift.profiles_of(store.read("profiles")), day_rows(spark, new), ["f"]).first()["psi"]
    assert found == drift.psi(day_rows(spark, old), day_rows(spark, new), ["f"]).first()["psi"] > 1
    plan = drift.psi_against(drift.profiles_of(store.read("profiles")), day_rows(spark, new), ["f"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Generate") == 1  # one row per column at the end, of counts


def test_rolling_reads_do_not_grow_with_the_dates(spark):
    rows = [(date(2024, 1, 1) + timedelta(days=i % 20), float((i * 37) % 101)) for i in range(2000)]
    df = spark.createDataFrame(rows, "run_date date, x double")
    asked = [date(2024, 1, d) for d in range(1, 21)]
    got = {r["run_date"]: r["psi"] for r in drift.rolling_drift(df, ["x"], asked, DriftSpec(enabled=True, reference="last_5_days")).collect()}
    for d in asked:
        ref = [(v,) for day, v in rows if d - timedelta(days=5) <= day < d]
        cur = [(v,) for day, v in rows if day == d]
        want = drift.psi(spark.createDataFrame(ref, "x double"), spark.createDataFrame(cur, "x double"), ["x"]).first()["psi"] if ref and d.day in (1, 7, 20) else None
        if want is not None:
            assert got[d] == pytest.approx(want, abs=5.1e-5)
    assert got[asked[0]] == 0.0 and len(got) == 20


# --- labels that arrive later ---

JUDGED = replace(
    PROJECT, schema=ColumnSpec(("id",), ("f",), ("s",)), monitoring=CheckSpec(null_output_max_pct=100.0, row_count_change_max_pct=1000.0),
    evaluation=EvalSpec(("auc_roc", "accuracy", "rmse", "r2", "log_loss"), {"accuracy": 0.6}, GroundTruthSpec("sql", "SELECT * FROM t_truth WHERE d = '{run_date}'", "y", 2)),
)


def test_late_labels_update_their_date(spark, store):
    for d, values in ((1, [1, 6, 8, 3, None]), (2, [2, 9])):
        jobs.daily_run(spark, store, JUDGED, SCORER, f"2024-01-0{d}", day_rows(spark, values))
    first = [("i0", False, date(2024, 1, 3)), ("i1", True, date(2024, 1, 3)), ("i1", True, date(2024, 1, 3)), ("zz", True, date(2024, 1, 3)),
             ("i2", None, date(2024, 1, 3))]
    spark.createDataFrame([(*r, date(2024, 1, 3)) for r in first], "id string, y boolean, label_date date, d date").createOrReplaceTempView("t_truth")
    got = {r["metric"]: r for r in jobs.take_truth(spark, store, JUDGED, "2024-01-03").collect()}
    assert got["accuracy"]["value"] == 1.0 and got["accuracy"]["n_labelled"] == 2 and got["accuracy"]["passed"] and got["auc_roc"]["value"] == 1.0
    more = [("i2", False, date(2024, 1, 3)), ("i1", False, date(2024, 1, 3)), ("i3", True, date(2024, 1, 3)), ("i0", True, date(2024, 1, 4)), ("i1", False, date(2024, 1, 4))]
    spark.createDataFrame([(*r, date(2024, 1, 4)) for r in more], "id string, y boolean, label_date date, d date").createOrReplaceTempView("t_truth")
    for _ in range(2):  # taking an arrival again changes nothing
        got = {(r["run_date"].day, r["metric"]): r for r in jobs.take_truth(spark, store, JUDGED, "2024-01-04").collect()}
        # day 1: scores .1 .6 .8 .3 of labels 0 1 0 1, the first label of i1 standing; day 2: .2 .9 of 1 0
        assert got[(1, "accuracy")]["value"] == 0.5 and got[(1, "accuracy")]["n_labelled"] == 4 and got[(1, "accuracy")]["passed"] is False
        assert got[(1, "auc_roc")]["value"] == 0.5 and got[(2, "auc_roc")]["value"] == 0.0
        y, p = np.array([0, 1, 0, 1]), np.array([0.1, 0.6, 0.8, 0.3])
        assert got[(1, "log_loss")]["value"] == pytest.approx(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)), abs=1e-6)
        told = (p >= 0.5).astype(int)
        assert got[(1, "rmse")]["value"] == pytest.approx(np.sqrt(np.mean((y - told) ** 2)), abs=1e-6)
        assert got[(1, "r2")]["value"] == pytest.approx(1 - np.mean((y - told) ** 2) / y.var(), abs=1e-6)
    backlog = {r["run_date"].day: (r["n_scored"], r["n_labelled"], r["overdue"]) for r in truth.label_backlog(store, JUDGED, date(2024, 1, 3)).collect()}
    assert backlog == {1: (5, 4, True), 2: (2, 2, False)}
    spark.createDataFrame([], "id string, y boolean, label_date date, d date").createOrReplaceTempView("t_truth")
    assert jobs.take_truth(spark, store, JUDGED, "2024-01-09").count() == 10
    jobs.take_truth(spark, store, JUDGED, "2024-01-04")  # an arrival that is withdrawn
    assert truth.label_backlog(store, JUDGED, date(2024, 1, 3)).filter("n_labelled = 2").count() == 1


def test_no_truth_is_an_error(spark, store):
    with pytest.raises(ValueError, match="no ground truth"):
        jobs.take_truth(spark, store, PROJECT, "2024-01-03")


# --- keys that are stored already ---


@pytest.mark.parametrize("size", [8, 1 << 20])
def test_unseen_keys_are_exact_at_any_filter_size(spark, size):
    stored = spark.createDataFrame([(i, "a" if i % 2 else None) for i in range(0, 900, 3)] * 2, "k int, t string")
    batch = spark.createDataFrame([(i, "a" if i % 2 else None, i) for i in range(1000)] + [(None, "a", -1)], "k int, t string, v int")
    got = sorted(r["v"] for r in sinks.unseen_keys(batch, stored, ["k", "t"], size).collect())
    known = {i for i in range(0, 900, 3) if i % 2}  # NULL equals nothing
    assert got == [-1] + [i for i in range(1000) if i not in known]
    assert sinks.unseen_keys(batch, stored.limit(0), ["k"]).count() == 1001


def test_one_row_per_key_in_the_whole_table(spark, store):
    project = replace(JUDGED, output=OutputSpec("r.k", "append", ("id",), "table"))
    df = lambda rows: spark.createDataFrame([(i, v, date(2024, 1, d)) for i, v, d in rows], "id string, s double, run_date date")
    days = [f"2024-01-0{d}" for d in (1, 2)]
    sinks.save_dates(store, df([("a", 1.0, 1), ("a", 2.0, 1), ("a", 9.0, 2), ("b", 3.0, 2)]), project, days)
    sinks.save_dates(store, df([("a", 5.0, 3), ("c", 6.0, 3)]), project, ["2024-01-03"])
    rows = lambda: sorted((r["id"], r["s"], r["run_date"].day) for r in store.read("r.k").collect())
    assert rows() == [("a", 2.0, 1), ("b", 3.0, 2), ("c", 6.0, 3)]
    again = replace(project, output=replace(project.output, write_mode="replace_date"))
    sinks.save_dates(store, df([("a", 7.0, 3), ("b", 8.0, 3)]), again, ["2024-01-03"])  # its own date does not count, the others do
    assert rows() == [("a", 2.0, 1), ("b", 3.0, 2)]


# --- files and databases ---


def test_cells_with_line_breaks_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t,u\n1,"say ""hi"", you",\n2,"two\nlines","  kept "\n3,"",x\n')
    (tmp_path / "b.csv").write_text('id,t\n1,"plain, quoted"\n2,x\n')
    got = [tuple(r) for r in readers.read_separated(spark, [str(tmp_path / "a.csv")]).collect()]
    assert got == [(1, 'say "hi", you', None), (2, "two\nlines", "  kept "), (3, None, "x")]
    assert [r["t"] for r in readers.read_separated(spark, [str(tmp_path / "b.csv")]).collect()] == ["plain, quoted", "x"]


def test_ranges_of_a_database_read():
    assert readers.range_predicates("id", 0, 99, 5_000_000) == [
        "id < 19 OR id IS NULL", "id >= 19 AND id < 39", "id >= 39 AND id < 59", "id >= 59 AND id < 79", "id >= 79"]
    assert readers.range_predicates("d", date(2024, 1, 1), date(2024, 1, 3), 9, 8) == ["d < '2024-01-02' OR d IS NULL", "d >= '2024-01-02'"]
    for low, high, n, parts in ((None, None, 0, 9), (5, 5, 10**9, None), ("a", "z", 10**9, None), (1, 9, 10, None)):
        assert readers.range_predicates("x", low, high, n, parts) == ["1 = 1"]
    for low, high in ((-7, 20), (0.5, 2.5), (0, 1)):
        cuts = readers.range_predicates("x", low, high, 100, 6)
        for i in range(60):
            x = low + (high - low) * i / 59
            hit = [c for c in cuts if eval(c.replace("OR x IS NULL", "").replace("AND", "and").replace("1 = 1", "True"), {"x": x})]
            assert len(hit) == 1
    spec = SourceSpec("jdbc", {"url": "jdbc:x", "partitionColumn": "id", "user": "u"}, "SELECT * FROM t")
    asked = readers.bounds_options(readers.jdbc_options(spec, "2024-01-01"))
    assert asked == {"url": "jdbc:x", "user": "u", "query": "SELECT MIN(id) AS low, MAX(id) AS high, COUNT(*) AS n FROM (SELECT * FROM t) batch"}


# --- metrics ---


def test_boolean_labels_and_added_ranked_metrics(spark):
    rng = np.random.default_rng(3)
    y, p = rng.random(200) < 0.3, np.round(rng.random(200), 1)
    rows = [(bool(a), float(b), bool(b > 0.5), "uv"[i % 2]) for i, (a, b) in enumerate(zip(y, p))]
    df = spark.createDataFrame(rows, "y boolean, p double, q boolean, g string")
    names = ["auc_roc", "f1_macro", "accuracy", "log_loss", "ks_statistic", "mse"]
    flags = [(r["metric"], r["value"]) for r in metrics.evaluate(df, names, "y", "q", "p").collect()]
    as_int = df.withColumns({"y": F.col("y").cast("int"), "q": F.col("q").cast("double")})
    assert sorted(flags) == sorted((r["metric"], r["value"]) for r in metrics.evaluate(as_int, names, "y", "q", "p").collect())
    assert all(v is not None for _, v in flags)
    add_ranked_metric(
        "average_precision", lambda t: {"a": F.sum(t.pos / t.pos_all * (t.pos_above / (t.pos_above + t.neg_above)))}, lambda parts: parts["a"]
    )
    got = {r["g"]: r["value"] for r in metrics.evaluate(df, ["average_precision"], "y", None, "p", by=["g"]).collect()}
    for g in "uv":
        mine = [(a, b) for a, b, _, k in rows if k == g]
        want, n_pos = 0.0, sum(a for a, _ in mine)
        for t in sorted({b for _, b in mine}):
            above = [a for a, b in mine if b >= t]
            want += sum(a for a, b in mine if b == t) / n_pos * sum(above) / len(above)
        assert got[g] == pytest.approx(want, abs=1e-6)
    missing = df.withColumn("p", F.when(F.col("p") > 0.1, F.col("p")))
    assert metrics.evaluate(missing, ["average_precision"], "y", None, "p").first()["value"] is None
