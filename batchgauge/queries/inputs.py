"""The example projects on the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchgauge.config import (
    CheckSpec, ColumnSpec, DriftSpec, EvalSpec, ModelRef, OutputSpec, Project,
)
from batchgauge.functions.columns import logistic
from batchgauge.operators.scoring import expression_scorer, scored_batch
from batchgauge.queries.registry import table

EVENTS = Project(
    project_id="events_score",
    display_name="Event risk",
    owner="examples",
    model=ModelRef("events_score"),
    schema=ColumnSpec(("event_id",), ("value", "hour", "k", "is_error"), ("risk", "load")),
    output=OutputSpec("results.event_scores", "append", ()),
    monitoring=CheckSpec(
        row_count_change_max_pct=5.0,
        null_output_max_pct=1.0,
        prediction_range={"risk": (0.0, 1.0), "load": (0.0, 1.0)},
        drift=DriftSpec(enabled=True),
        alert_channel="#event-alerts",
    ),
    evaluation=EvalSpec(("auc_roc", "ks_statistic"), {"auc_roc": 0.5}),
)

FEATURES = ["value", "hour", "k", "is_error"]


def events_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with its features and date."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "ts",
        F.hour("ts").alias("hour"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("event_type") == "error").cast("int").alias("is_error"),
        F.to_date("ts").alias("run_date"),
    )


def risk() -> Column:
    return logistic(
        0.02 * F.col("value") + 0.01 * F.col("k") - 0.05 * F.col("hour") + 0.8 * F.col("is_error") - 1.5
    )


def _event_outputs() -> dict[str, Column]:
    # Scores are missing where the model has nothing to say: NULL for risk, NaN for load.
    return {
        "risk": F.when(F.col("k") != 0, risk()),
        "load": F.when(F.col("k") == 99, F.lit(float("nan"))).otherwise(F.col("value") / 300),
    }


EVENT_SCORER = expression_scorer(_event_outputs)


def events_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, risk, load, run_date for all days at once."""
    return scored_batch(events_batch(spark, sf_dir), EVENT_SCORER, EVENTS.schema, F.col("run_date"))


def events_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs a day; the middle one fails on days with many errors in it."""
    failed = (F.col("part") == 1) & (F.col("errors") > 15)
    return (
        events_batch(spark, sf_dir)
        .groupBy("run_date", F.floor(F.col("hour") / 8).alias("part"))
        .agg(F.count("*").alias("row_count"), F.sum("is_error").alias("errors"), F.max("ts").alias("created_at"))
        .select(
            F.lit(EVENTS.project_id).alias("project_id"), "run_date",
            F.when(failed, "failed").otherwise("success").alias("status"), "row_count", "created_at",
        )
    )


def typed_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per event type, day and hour, as the run log of several projects."""
    return (
        events_batch(spark, sf_dir)
        .groupBy("event_type", "run_date", "hour")
        .agg(F.count("*").alias("row_count"), F.max("value").alias("top"), F.max("ts").alias("created_at"))
        .select(
            F.concat(F.lit("score_"), "event_type").alias("project_id"), "run_date",
            F.when(F.col("top") > 200, "failed").otherwise("success").alias("status"),
            "row_count", F.round(F.col("top") / 10, 2).alias("duration_sec"), "created_at",
        )
    )


def typed_monitoring_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three checks per event type and day, as the monitoring log of several projects."""
    stats = events_batch(spark, sf_dir).groupBy("event_type", "run_date").agg(
        F.count("*").cast("double").alias("rows"), F.avg("value").alias("mean"), F.max("value").alias("top"),
        F.max("ts").alias("created_at"),
    )
    def check(name: str, value: str, limit: float):
        v = F.round(value, 6)
        return F.struct(
            F.lit(name).alias("check_name"), (v <= limit).alias("passed"), v.alias("value"),
            F.lit(limit).alias("threshold"),
        )

    checks = F.array(
        check("row_count_change", "rows", 70.0), check("null_outputs", "mean", 50.0), check("range_load", "top", 300.0)
    )
    return stats.select(
        F.concat(F.lit("score_"), "event_type").alias("project_id"), "run_date", "created_at", F.inline(checks)
    )


BATCH_SQL = """
batch AS (
  SELECT event_id, user_id, event_type, value, ts,
         CAST(date_part('hour', ts) AS INT) AS hour,
         CAST(regexp_extract(props, '[0-9]+') AS INT) AS k,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_error,
         CAST(ts AS DATE) AS run_date
  FROM events)"""

RISK_SQL = "1 / (1 + exp(-(0.02 * value + 0.01 * k - 0.05 * hour + 0.8 * is_error - 1.5)))"

SCORED_SQL = BATCH_SQL + f""",
scored AS (
  SELECT event_id, CASE WHEN k <> 0 THEN {RISK_SQL} END AS risk,
         CASE WHEN k <> 99 THEN value / 300 END AS load, run_date
  FROM batch)"""

RUN_LOG_SQL = """
run_log AS (
  SELECT 'events_score' AS project_id, run_date,
         CASE WHEN part = 1 AND errors > 15 THEN 'failed' ELSE 'success' END AS status,
         row_count, created_at
  FROM (SELECT run_date, CAST(floor(hour / 8) AS INT) AS part, count(*) AS row_count,
               sum(is_error) AS errors, max(ts) AS created_at
        FROM batch GROUP BY ALL)),
last_success AS (
  SELECT project_id, run_date, arg_max(row_count, created_at) AS row_count
  FROM run_log WHERE status = 'success' GROUP BY ALL)"""

TYPED_LOG_SQL = BATCH_SQL + """,
run_log AS (
  SELECT 'score_' || event_type AS project_id, run_date,
         CASE WHEN top > 200 THEN 'failed' ELSE 'success' END AS status,
         row_count, round(top / 10, 2) AS duration_sec, created_at
  FROM (SELECT event_type, run_date, hour, count(*) AS row_count, max(value) AS top, max(ts) AS created_at
        FROM batch GROUP BY ALL))"""

TYPED_CHECKS_SQL = BATCH_SQL + """,
stats AS (
  SELECT 'score_' || event_type AS project_id, run_date, CAST(count(*) AS DOUBLE) AS n, avg(value) AS mean,
         max(value) AS top, max(ts) AS created_at
  FROM batch GROUP BY event_type, run_date),
monitoring_log AS (
  SELECT project_id, run_date, created_at, 'row_count_change' AS check_name, round(n, 6) <= 70 AS passed,
         round(n, 6) AS value, 70.0::DOUBLE AS threshold FROM stats
  UNION ALL
  SELECT project_id, run_date, created_at, 'null_outputs', round(mean, 6) <= 50, round(mean, 6), 50 FROM stats
  UNION ALL
  SELECT project_id, run_date, created_at, 'range_load', round(top, 6) <= 300, round(top, 6), 300 FROM stats)"""
