from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import functions as F, types as T

from batchgauge.config import ColumnSpec, ModelRef, OutputSpec, Project
from batchgauge.operators import sinks

PROJECT = Project("p1", model=ModelRef("m"), schema=ColumnSpec(("id",), ("f",), ("p",)), output=OutputSpec("results.scores"))
REPLACE = PROJECT.with_write_mode("replace_date")
SCORED = "id string, p double, run_date date"
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCORED)


def stored(store, project=PROJECT):
    df = store.result(project, T._parse_datatype_string(SCORED))
    return sorted((r["id"], r["run_date"], r["p"]) for r in df.collect())


def test_append_then_skip(spark, store):
    assert sinks.save(store, batch(spark, [("a", 0.1, D1), ("b", 0.2, D1)]), PROJECT, D1) == 2
    assert sinks.save(store, batch(spark, [("c", 0.9, D1)]), PROJECT, D1) == 0
    assert sinks.save(store, batch(spark, [("c", 0.9, D2)]), PROJECT, D2) == 1
    assert stored(store) == [("a", D1, 0.1), ("b", D1, 0.2), ("c", D2, 0.9)]


def test_any_other_mode_behaves_like_append(spark, store):
    odd = PROJECT.with_write_mode("whatever")
    assert sinks.save(store, batch(spark, [("a", 0.1, D1)]), odd, D1) == 1
    assert sinks.save(store, batch(spark, [("a", 0.5, D1)]), odd, D1) == 0


def test_replace_leaves_other_dates(spark, store):
    sinks.save_dates(store, batch(spark, [("a", 0.1, D1), ("b", 0.2, D2), ("c", 0.3, D2)]), PROJECT, [D1, D2])
    assert sinks.save(store, batch(spark, [("z", 0.9, D2)]), REPLACE, D2) == 1  # fewer rows than before
    assert stored(store) == [("a", D1, 0.1), ("z", D2, 0.9)]
    assert sinks.save(store, batch(spark, [("z", 0.9, D2)]), REPLACE, D2) == 1  # again: the same table
    assert stored(store) == [("a", D1, 0.1), ("z", D2, 0.9)]


def test_replace_with_an_empty_batch_clears_the_date(spark, store):
    sinks.save_dates(store, batch(spark, [("a", 0.1, D1), ("b", 0.2, D2)]), PROJECT, [D1, D2])
    assert sinks.save(store, batch(spark, []), REPLACE, D1) == 0
    assert stored(store) == [("b", D2, 0.2)]
    assert sinks.save(store, batch(spark, [("n", 0.4, D1)]), PROJECT, D1) == 1
    assert stored(store) == [("b", D2, 0.2), ("n", D1, 0.4)]


def test_many_dates_skip_only_the_present_ones(spark, store):
    sinks.save(store, batch(spark, [("a", 0.1, D2)]), PROJECT, D2)
    got = sinks.save_dates(store, batch(spark, [("x", 0.5, d) for d in (D1, D2, D3)]), PROJECT, [D1, D2, D3])
    assert got == {D1: "success", D2: "skipped", D3: "success"}
    assert stored(store) == [("a", D2, 0.1), ("x", D1, 0.5), ("x", D3, 0.5)]


def test_run_date_is_added_when_absent(spark, store):
    df = spark.createDataFrame([("a", 0.1)], "id string, p double")
    assert sinks.save(store, df, PROJECT, "2024-01-02") == 1
    assert stored(store) == [("a", D2, 0.1)]
    assert sinks.with_run_date(batch(spark, [("a", 0.1, D1)]), "2024-01-02").head()["run_date"] == D1


def test_dedup_key_on_save(spark, store):
    keyed = replace(PROJECT, output=OutputSpec("results.keyed", dedup_key=("id", "run_date")))
    assert sinks.save(store, batch(spark, [("a", 0.1, D1), ("a", 0.7, D1), ("b", 0.2, D1)]), keyed, D1) == 2
    assert stored(store, keyed) == [("a", D1, 0.7), ("b", D1, 0.2)]


def test_dedup_is_total_and_repeatable(spark):
    rows = [(i % 3, i % 5, float(i)) for i in range(60)] + [(None, 1, 1.0), (None, 1, 2.0)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    got = sorted(map(tuple, sinks.dedup_keys(df.repartition(7), ["k"], ["t"]).collect()), key=str)
    assert got == sorted([(0, 4, 54.0), (1, 4, 49.0), (2, 4, 59.0), (None, 1, 2.0)], key=str)
    assert sinks.dedup_keys(df.select("k"), ["k"]).count() == 4


def test_dedup_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("0 AS k", "id AS v")
    plan = sinks.dedup_keys(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_unseen_keys(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    old = spark.createDataFrame([(2, "z")], "id int, v string")
    assert [r["id"] for r in sinks.unseen_keys(new, old, ["id"]).collect()] == [1]


def test_result_schema_is_typed_and_partitioned(spark, store):
    schema = sinks.result_schema(PROJECT.schema, T._parse_datatype_string(SCORED))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("id", "string"), ("run_date", "date"), ("p", "double"), ("created_at", "timestamp")]
    sinks.save(store, batch(spark, [("a", 0.1, D1)]), PROJECT, D1, created_at=datetime(2024, 5, 1))
    row = store.result(PROJECT, T._parse_datatype_string(SCORED)).head()
    assert row["created_at"] == datetime(2024, 5, 1)
    plan = store.result(PROJECT, T._parse_datatype_string(SCORED)).filter(F.col("run_date") == F.lit(D1))
    assert "PartitionFilters: [isnotnull(run_date" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_date_with_most_rows_is_written_by_several_tasks(spark, store):
    df = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(0.5).alias("p"), F.lit(D1).alias("run_date"))
    sinks.save(store, df, PROJECT, D1)
    plan = df.hint("rebalance", "run_date")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and len(stored(store)) == 200


def test_platform_tables_are_created_once(spark, store):
    store.ensure_platform_tables()
    sinks.log_run(store, PROJECT, D1, "success", 5, 45.219, created_at=datetime(2024, 1, 1, 3))
    store.ensure_platform_tables()
    rows = store.read("run_log").collect()
    assert len(rows) == 1 and store.read("project_registry").count() == 0
    r = rows[0]
    assert (r["project_id"], r["run_date"], r["status"], r["row_count"], r["duration_sec"], r["error_message"]) == (
        "p1", D1, "success", 5, 45.22, None)
    sinks.log_run(store, replace(PROJECT, project_id="007"), D1, "failed", error_message="boom")
    assert {r["project_id"] for r in store.read("run_log").collect()} == {"p1", "007"}


def test_check_rows_are_logged_in_one_write(spark, store):
    store.ensure_platform_tables()
    report = spark.createDataFrame([("p1", D1, 1, "row_count_change", True, 3.0, 20.0, "m"), ("p1", D1, 2, "x", False, None, None, "n")],
                                   "project_id string, run_date date, seq int, check_name string, passed boolean, value double, threshold double, message string")
    sinks.log_checks(store, report, datetime(2024, 1, 1))
    got = sorted(store.read("monitoring_log").collect(), key=lambda r: r["check_name"])
    assert [(r["check_name"], r["passed"], r["value"]) for r in got] == [("row_count_change", True, 3.0), ("x", False, None)]


def test_ingest(spark, store, tmp_path):
    (tmp_path / "in.csv").write_text("id,v\n" + "".join(f"{i},{i / 2}\n" for i in range(300)))
    assert sinks.ingest_csv(store, str(tmp_path / "in.csv"), "features.t").count() == 300
    sample = sinks.ingest_csv(store, str(tmp_path / "in.csv"), "features.t", sample_n=40, key=["id"])
    assert sample.count() == 40 and sample.dtypes == [("id", "int"), ("v", "double")]
    assert sinks.ingest_csv(store, str(tmp_path / "in.csv"), "features.t", sample_n=5000).count() == 300
