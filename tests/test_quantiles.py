import numpy as np
import pytest

from batchgauge.functions import quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.95, 1.0]


def frame(spark, columns):
    n = max(len(v) for v in columns.values())
    rows = [tuple(float(v[i]) if i < len(v) else None for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(5)


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.normal(size=3000),
        "skewed": rng.exponential(size=2500) ** 3,
        "hot": np.concatenate([np.full(1500, 2.5), rng.normal(size=1500)]),  # half of all rows are one value
        "constant": np.full(40, -1.0),
        "few": rng.integers(0, 4, 999),
        "one": np.array([3.0]),
        "signed/zero": np.array([0.0, -0.0, 1.0, -1.0]),
    }


def test_equal_to_numpy(spark, samples):
    got = quantiles.exact_quantiles(frame(spark, samples), list(samples), PROBS).collect()
    assert {r["column"] for r in got} == set(samples)
    for r in got:
        want = np.percentile(samples[r["column"]], [p * 100 for p in PROBS])
        assert r["n"] == len(samples[r["column"]])
        np.testing.assert_allclose(r["quantiles"], want, rtol=1e-15, atol=0)


@pytest.mark.parametrize("cells", [2, 3, 500])
def test_cells_do_not_change_the_result(spark, samples, cells):
    got = quantiles.exact_quantiles(frame(spark, samples), ["normal", "hot"], PROBS, cells=cells).collect()
    for r in got:
        np.testing.assert_allclose(r["quantiles"], np.percentile(samples[r["column"]], [p * 100 for p in PROBS]), rtol=1e-15)


def test_missing_values_are_left_out_and_empty_columns_have_no_row(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None), (None, float("nan"))], "a double, b double")
    got = quantiles.exact_quantiles(df, ["a", "b"], [0.5]).collect()
    assert [(r["column"], r["n"], r["quantiles"]) for r in got] == [("a", 2, [2.0])]


def test_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 2000), rng.normal(size=2000))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: r["quantiles"] for r in quantiles.exact_quantiles(df, ["v"], [0.1, 0.5], ["g"], 3).collect()}
    for g in range(3):
        np.testing.assert_allclose(got[g], np.percentile([v for k, v in rows if k == g], [10, 50]), rtol=1e-15)


def test_sketch_is_close(spark, samples):
    got = quantiles.approx_quantiles(frame(spark, samples), ["normal"], [0.5]).head()
    assert abs(got["quantiles"][0] - np.median(samples["normal"])) < 0.01


def test_only_values_near_the_ranks_are_shuffled_by_value(spark, samples):
    df = frame(spark, samples)
    plan = quantiles.exact_quantiles(df, ["normal"], [0.5])._jdf.queryExecution().executedPlan().toString()
    # The value grouping sits above the join with the wanted cells.
    assert "BroadcastHashJoin [idx" in plan
