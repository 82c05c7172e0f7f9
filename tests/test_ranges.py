import numpy as np
import pytest
from pyspark.sql import functions as F

from batchgauge.functions.quantiles import exact_quantiles
from batchgauge.functions.ranges import in_ranges, positioned, range_count, running_sums
from batchgauge.operators import metrics, sampling, views
from batchgauge.session import written


@pytest.mark.parametrize("bound", [3, 10, 1000])
def test_running_sums_at_any_bound(spark, bound):
    rng = np.random.default_rng(4)
    rows = [(None if g == 2 else int(g), float(v), int(w)) for g, v, w in zip(rng.integers(0, 3, 80), rng.permutation(80), rng.integers(0, 9, 80))]
    stored = written(spark.createDataFrame(rows, "g int, v double, w int").repartition(5), "t")
    got = {(r["g"], r["v"]): (r["w_upto"], r["w_all"]) for r in running_sums(stored, ["v"], ["w"], ["g"], bound).collect()}
    for g, v, _ in rows:
        mine = [r for r in rows if r[0] == g]
        assert got[(g, v)] == (sum(r[2] for r in mine if r[1] <= v), sum(r[2] for r in mine))


def test_ranges_follow_the_rows(spark):
    assert [range_count(n, 10) for n in (0, 1, 10, 11, 100_000)] == [1, 1, 1, 2, 10_000]
    stored = written(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(6), "t")
    sizes = [r["count"] for r in in_ranges(stored, [F.asc("k")], 10).groupBy("_range").count().collect()]
    assert len(sizes) > 60 and max(sizes) < 60
    got = positioned(stored, [F.desc("k")], 10).collect()
    assert all(r["pos"] == 999 - r["k"] for r in got)


@pytest.mark.parametrize("bound", [10, 10**6])
def test_ranking_metrics_at_any_bound(spark, bound):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 400), np.round(rng.random(400), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double").repartition(7)
    got = metrics.ranked_metrics(df, "y", "p", rows_per_range=bound).first()
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > neg).mean() + (a == neg).mean() / 2 for a in pos])
    ks = max(abs((pos <= t).mean() - (neg <= t).mean()) for t in p)
    assert got["auc_roc"] == pytest.approx(auc, abs=1e-12) and got["ks_statistic"] == pytest.approx(ks, abs=1e-12)


def test_samples_at_any_bound(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g")).repartition(6)
    for n in (1, 50, 777, 19_999):
        few, many = (sorted(r["k"] for r in sampling.sample_rows(df, n, ["k"], rows_ranked=b).collect()) for b in (1, 100_000))
        assert few == many and len(few) == n
    few, many = (sorted(r["k"] for r in sampling.stratified_split(df, "g", ["k"], rows_ranked=b).filter("split = 'test'").collect()) for b in (2, 100_000))
    assert few == many and len(few) == 3 * 1333


def test_a_sample_ends_within_copies_of_one_row(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(i,) for i in range(2, 40)], "k int")
    assert sampling.sample_rows(df, 300, ["k"], rows_ranked=10).count() == 300


def test_limits_over_text_keys_with_ties(spark):
    rows = [(None if i % 9 == 0 else "ab"[i % 7 == 0], i) for i in range(6000)]
    df = spark.createDataFrame(rows, "t string, v int").repartition(8)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for n in (1001, 2500, 5900):
        assert [tuple(r) for r in views.first_rows(df, n, ["t", "v"], rows_per_range=100).collect()] == want[:n]
    assert sorted(r["v"] for r in views.first_rows(df, 1500, ["t"]).collect()) == sorted(r[1] for r in want[:1500])


def test_limits_narrow_before_they_rank(spark, monkeypatch):
    monkeypatch.setattr(views, "_SAMPLED_KEYS", 5000)
    seen = {}
    real = views.positioned
    monkeypatch.setattr(views, "positioned", lambda near, *a: seen.setdefault("rows", near.count()) and real(near, *a))
    df = spark.range(60_000).select((F.col("id") % 5).cast("string").alias("t"), F.col("id").alias("v"))
    got = views.first_rows(df, 2000, ["t", "v"]).collect()
    assert [r["v"] for r in got] == list(range(0, 10_000, 5)) and seen["rows"] < 8000


def test_quantiles_whose_cells_are_cut_again(spark):
    rng = np.random.default_rng(7)
    rows = [(int(g), float(v), float(v) ** 2) for g, v in zip(rng.integers(0, 2, 900), np.round(rng.normal(0, 9, 900), 1))]
    df = spark.createDataFrame(rows, "g int, x double, y double").repartition(5)
    probs = [0.1, 0.25, 0.5, 0.77]
    got = {(r["g"], r["column"]): r for r in exact_quantiles(df, ["x", "y"], probs, ["g"], cells=3, rows_per_range=10).collect()}
    assert len(got) == 4
    for (g, column), r in got.items():
        own = np.array([x if column == "x" else y for k, x, y in rows if k == g])
        assert r["quantiles"] == pytest.approx(np.quantile(own, probs).tolist(), abs=1e-9)
        assert r["below"] == [int((own < q).sum()) for q in r["quantiles"]] and r["n"] == len(own)
