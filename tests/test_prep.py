import hashlib
import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchgauge.functions import columns
from batchgauge.operators import metrics, prep, sampling


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_expressions(spark):
    df = spark.createDataFrame([(4.0, 2.0, "state"), (1.0, 0.0, "x"), (None, 5.0, None), (0.2, None, "state")],
                               "a double, b double, s string").coalesce(1)
    assert values(df, columns.safe_ratio(F.col("a"), F.col("b"))) == [2.0, None, None, None]
    assert values(df, columns.log_floor(F.col("a"))) == [math.log(4), 0.0, None, 0.0]
    assert values(df, columns.indicator(F.col("s"), "state")) == [1, 0, 0, 1]


def test_date_range(spark):
    df = spark.createDataFrame([(date(2024, 2, 28), date(2024, 3, 1)), (date(2024, 1, 1), date(2024, 1, 1)),
                                (date(2024, 1, 2), date(2024, 1, 1))], "a date, b date").coalesce(1)
    got = values(df, columns.run_date_range(F.col("a"), F.col("b")))
    assert [len(g) for g in got] == [3, 1, 0] and got[0][1] == date(2024, 2, 29)


def test_impute_and_scale(spark):
    df = spark.createDataFrame([(1.0, 7.0, None), (None, 7.0, None), (float("nan"), None, None), (4.0, 7.0, None), (10.0, 7.0, None)],
                               "x double, c double, e double").coalesce(1)
    filled = prep.impute_median(df, ["x", "c", "e"])
    assert [r["x"] for r in filled.collect()] == [1.0, 4.0, 4.0, 4.0, 10.0]
    assert [r["e"] for r in filled.collect()] == [None] * 5
    scaled = prep.min_max(filled, ["x", "c", "e"]).collect()
    assert [r["x"] for r in scaled] == pytest.approx([0, 1 / 3, 1 / 3, 1 / 3, 1])
    assert [r["c"] for r in scaled] == [0.5] * 5 and [r["e"] for r in scaled] == [None] * 5


def test_scaler(spark):
    df = spark.createDataFrame([(float(v), 3.0) for v in (1, 2, 3, 4)], "x double, c double").coalesce(1)
    fitted = prep.fit_scaler(df, ["x", "c"])
    got = prep.apply_scaler(df, fitted).collect()
    want = (np.arange(1, 5) - 2.5) / np.arange(1, 5).std()
    assert [r["x"] for r in got] == pytest.approx(want.tolist()) and [r["c"] for r in got] == [0.0] * 4


def test_logistic_around_a_quantile(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "s double").coalesce(1)
    got = values(df, prep.logistic_from_quantile(df, "s"))
    assert got[95] == 0.5 and got[94] == pytest.approx(1 / (1 + math.exp(10)))


@pytest.fixture
def firms(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), None if i % 50 == 0 else float(b)) for i, (a, b) in enumerate(rng.normal(size=(3000, 2)))]
    return spark.createDataFrame(rows, "id int, dtd double, sigma double")


def test_labels_do_not_depend_on_partitioning(firms):
    weights = {"dtd": -0.3, "sigma": 0.2}
    one = prep.synthetic_labels(firms.repartition(1), weights, ["id"])
    many = prep.synthetic_labels(firms.repartition(13), weights, ["id"])
    key = lambda df: {r["id"]: (round(r["risk"], 9), r["label"]) for r in df.collect()}
    assert key(one) == key(many)
    balance = prep.label_balance(one, "label").head()
    assert balance["n"] == 3000 and 0.02 < balance["rate"] < 0.2 and balance["positives"] == round(balance["rate"] * 3000)
    other = prep.synthetic_labels(firms, weights, ["id"], seed=1)
    assert key(other) != key(one)


def test_hash_draws_look_uniform_and_normal(spark):
    df = spark.range(20000).select(
        columns.hash_uniform([F.col("id")], 42).alias("u"), columns.hash_normal([F.col("id")], 42).alias("z")
    ).toPandas()
    assert 0 < df.u.min() and df.u.max() < 1 and abs(df.u.mean() - 0.5) < 0.01
    assert abs(df.z.mean()) < 0.03 and abs(df.z.std() - 1) < 0.03


def digest(key, seed=42):
    return hashlib.md5(f"{key}|{seed}".encode()).hexdigest()


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    want = sorted(range(20000), key=lambda k: (digest(k), k))[:777]
    for parts in (1, 11):
        got = sampling.sample_rows(df.repartition(parts), 777, ["k"])
        assert sorted(r["k"] for r in got.collect()) == sorted(want)
    assert sampling.sample_rows(df, 50_000, ["k"]).count() == 20000
    assert sampling.sample_rows(df, 0, ["k"]).count() == 0


def test_sample_of_copies(spark):
    rows = [("hot",)] * 5000 + [(f"r{i}",) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string").repartition(6)
    for n in (1, 2500, 7000, 8000):
        assert sampling.sample_rows(df, n, ["k"]).count() == n


def test_copies_are_taken_up_to_the_count(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_CHUNK", 7)  # several chunks per copied row
    df = spark.createDataFrame([("hot", 1)] * 100, "k string, v int")
    got = sampling.sample_rows(df, 33, ["k"]).collect()
    assert [tuple(r) for r in got] == [("hot", 1)] * 33


def test_split_is_exact_per_label(spark):
    rows = [(i, "big" if i % 10 else ("small" if i % 20 else None)) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, y string")
    got = sampling.stratified_split(df, "y", ["k"]).toPandas()
    assert len(got) == 5000 and got.k.nunique() == 5000
    for label, n in (("big", 4500), ("small", 250), (None, 250)):
        part = got[got.y.isna()] if label is None else got[got.y == label]
        assert len(part) == n and (part.split == "test").sum() == round(n * 0.2)
        want = sorted(part.k, key=lambda k: (digest(k), k))[: round(n * 0.2)]
        assert sorted(part[part.split == "test"].k) == sorted(want)


def test_split_beyond_the_broadcast_check(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_BROADCAST_STRATA", 2)
    df = spark.range(1000).selectExpr("id AS k", "cast(id % 5 AS int) AS y")
    got = sampling.stratified_split(df, "y", ["k"]).groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]): r["count"] for r in got} == {(y, s): n for y in range(5) for s, n in (("test", 40), ("train", 160))}


def test_boosted_trees(spark, firms):
    df = prep.impute_median(firms, ["sigma"]).withColumn("label", (F.col("dtd") > 0.3).cast("int"))
    split = sampling.stratified_split(df, "label", ["id"])
    model = prep.train_boosted(split.filter("split = 'train'"), ["dtd", "sigma"], "label", rounds=3)
    scored = prep.score_boosted(model, split.filter("split = 'test'"), ["dtd", "sigma"])
    assert metrics.ranked_metrics(scored, "label", "score").head()["auc_roc"] > 0.95
    top = prep.feature_importance(spark, model, ["dtd", "sigma"]).orderBy(F.desc("importance")).head()
    assert top["feature"] == "dtd"
