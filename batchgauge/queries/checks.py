"""Gates, health checks and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgauge.functions.columns import severity_prefix
from batchgauge.operators import alerts, gates, monitor
from batchgauge.plans import jobs
from batchgauge.queries.inputs import (
    BATCH_SQL, EVENTS, FEATURES, RUN_LOG_SQL, SCORED_SQL, events_batch, events_run_log, events_scored,
)
from batchgauge.queries.registry import query, rounded

_COUNTS = SCORED_SQL + """,
counts AS (
  SELECT run_date, count(*) AS n_rows,
         count(*) FILTER (risk IS NULL) AS missing_risk, count(*) FILTER (load IS NULL) AS missing_load,
         count(risk) AS present_risk, count(load) AS present_load,
         count(*) FILTER (risk < 0 OR risk > 1) AS out_risk, count(*) FILTER (load < 0 OR load > 1) AS out_load
  FROM scored GROUP BY run_date)"""

_GATES = _COUNTS + """,
gate AS (
  SELECT run_date, 1 AS seq, 'not_empty' AS check_name, NULL AS "column", n_rows > 0 AS passed,
         CAST(n_rows AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS VARCHAR) AS message,
         'ValidationError' AS error FROM counts
  UNION ALL SELECT run_date, 2, 'output_columns_present', NULL, true, NULL, NULL, NULL, 'ValidationError' FROM counts
  UNION ALL SELECT run_date, 3, 'null_pct', 'risk', missing_risk * 100.0 / n_rows <= 1.0, missing_risk * 100.0 / n_rows, 1.0,
    printf('Column ''risk'' has %.1f%% NaN values (threshold: 1.0%%)', round(missing_risk * 100.0 / n_rows, 1)), 'QualityError' FROM counts
  UNION ALL SELECT run_date, 4, 'null_pct', 'load', missing_load * 100.0 / n_rows <= 1.0, missing_load * 100.0 / n_rows, 1.0,
    printf('Column ''load'' has %.1f%% NaN values (threshold: 1.0%%)', round(missing_load * 100.0 / n_rows, 1)), 'QualityError' FROM counts
  UNION ALL SELECT run_date, 5, 'range', 'risk', out_risk = 0, out_risk, 0.0,
    printf('Column ''risk'' has %d values outside range [0.0, 1.0]', out_risk), 'QualityError' FROM counts
  UNION ALL SELECT run_date, 6, 'range', 'load', out_load = 0, out_load, 0.0,
    printf('Column ''load'' has %d values outside range [0.0, 1.0]', out_load), 'QualityError' FROM counts)"""


def _report(spark, sf_dir):
    return gates.output_report(
        events_scored(spark, sf_dir), EVENTS.schema, EVENTS.monitoring, ["run_date"]
    ).withColumns(rounded("value"))


@query("gate_report_all", f"""WITH {_GATES}
SELECT run_date, seq, check_name, "column", passed, round(value, 6) AS value, threshold,
       CASE WHEN NOT passed THEN message END AS message, error FROM gate""")
def gate_report_all(spark, sf_dir):
    return _report(spark, sf_dir)


@query("gate_null_pct", f"""WITH {_GATES}
SELECT run_date, "column", round(value, 6) AS value, passed FROM gate WHERE check_name = 'null_pct'""")
def gate_null_pct(spark, sf_dir):
    return _report(spark, sf_dir).filter("check_name = 'null_pct'").select("run_date", "column", "value", "passed")


@query("gate_range", f"""WITH {_GATES}
SELECT run_date, "column", value, passed FROM gate WHERE check_name = 'range'""")
def gate_range(spark, sf_dir):
    return _report(spark, sf_dir).filter("check_name = 'range'").select("run_date", "column", "value", "passed")


@query("gate_first_failure", f"""WITH {_GATES}
SELECT run_date, arg_min(error, seq) FILTER (NOT passed) AS error, arg_min(message, seq) FILTER (NOT passed) AS message
FROM gate GROUP BY run_date""")
def gate_first_failure(spark, sf_dir):
    return gates.first_failure(_report(spark, sf_dir), ["run_date"])


@query("feature_null_report", f"""WITH {BATCH_SQL},
cells AS (
  SELECT run_date, 'value' AS "column", k = 0 AS missing FROM batch
  UNION ALL SELECT run_date, 'hour', hour = 3 FROM batch
  UNION ALL SELECT run_date, 'k', false FROM batch
  UNION ALL SELECT run_date, 'is_error', false FROM batch)
SELECT run_date, "column", round(avg(CAST(missing AS INT)) * 100, 6) AS null_pct FROM cells GROUP BY ALL""")
def feature_null_report(spark, sf_dir):
    batch = events_batch(spark, sf_dir).withColumns({
        "value": F.when(F.col("k") == 0, F.lit(float("nan"))).otherwise(F.col("value")),
        "hour": F.when(F.col("hour") != 3, F.col("hour")),
    })
    return gates.feature_null_report(batch, FEATURES, ["run_date"]).withColumns(rounded("null_pct"))


@query("gate_outcome_by_date", f"""WITH {_GATES},
days AS (
  SELECT CAST(unnest(generate_series(min(run_date) - INTERVAL 1 DAY, max(run_date) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS run_date
  FROM counts),
first AS (
  SELECT run_date, arg_min(error, seq) FILTER (NOT passed) AS error, arg_min(message, seq) FILTER (NOT passed) AS message,
         CAST(max(value) FILTER (seq = 1) AS BIGINT) AS n_rows
  FROM gate GROUP BY run_date)
SELECT run_date, coalesce(n_rows, 0) AS n_rows,
       CASE WHEN n_rows IS NULL THEN 'ValidationError' ELSE error END AS error,
       CASE WHEN n_rows IS NULL THEN 'Input DataFrame is empty — no rows returned from data source' ELSE message END AS message
FROM days LEFT JOIN first USING (run_date)""")
def gate_outcome_by_date(spark, sf_dir):
    batch, scored = events_batch(spark, sf_dir), events_scored(spark, sf_dir)
    ends = scored.agg(F.date_sub(F.min("run_date"), 1).alias("a"), F.date_add(F.max("run_date"), 1).alias("b"))
    days = ends.select(F.explode(F.sequence("a", "b")).alias("run_date"))
    return jobs.gate_outcomes(batch, scored, EVENTS, days)


_MONITOR = _COUNTS + "," + RUN_LOG_SQL + """,
prior AS (
  SELECT c.*, l.row_count AS prev FROM counts c ASOF LEFT JOIN last_success l ON c.run_date > l.run_date),
report AS (
  SELECT run_date, 1 AS seq, 'row_count_change' AS check_name,
         coalesce(prev, 0) = 0 OR abs(n_rows - prev) * 1.0 / prev * 100 <= 5 AS passed,
         CASE WHEN coalesce(prev, 0) = 0 THEN n_rows ELSE round(abs(n_rows - prev) * 1.0 / prev * 100, 1) END AS value,
         5.0::DOUBLE AS threshold,
         CASE WHEN coalesce(prev, 0) = 0 THEN printf('No previous run to compare (count=%d)', n_rows)
              ELSE printf('Row count changed %.1f%% (%d -> %d, max allowed: 5.0%%)',
                          round(abs(n_rows - prev) * 1.0 / prev * 100, 1), prev, n_rows) END AS message FROM prior
  UNION ALL
  SELECT run_date, 2, 'null_outputs', (missing_risk + missing_load) * 100.0 / (2 * n_rows) <= 1,
         round((missing_risk + missing_load) * 100.0 / (2 * n_rows), 2), 1.0,
         printf('%.2f%% NaN in output columns (max: 1.0%%)', round((missing_risk + missing_load) * 100.0 / (2 * n_rows), 2)) FROM prior
  UNION ALL
  SELECT run_date, 3, 'range_risk', out_risk = 0, round(out_risk * 100.0 / present_risk, 2), 0.0,
         printf('%d/%d values outside [0.0, 1.0] (%.2f%%)', out_risk, present_risk, round(out_risk * 100.0 / present_risk, 2)) FROM prior
  UNION ALL
  SELECT run_date, 4, 'range_load', out_load = 0, round(out_load * 100.0 / present_load, 2), 0.0,
         printf('%d/%d values outside [0.0, 1.0] (%.2f%%)', out_load, present_load, round(out_load * 100.0 / present_load, 2)) FROM prior)"""


def _monitor(spark, sf_dir):
    return monitor.monitor_report(events_scored(spark, sf_dir), events_run_log(spark, sf_dir), EVENTS)


@query("mon_report", f"""WITH {_MONITOR}
SELECT 'events_score' AS project_id, run_date, seq, check_name, passed, value, threshold, message FROM report""")
def mon_report(spark, sf_dir):
    return _monitor(spark, sf_dir)


@query("mon_row_count_change", f"""WITH {_MONITOR}
SELECT run_date, passed, value, threshold, message FROM report WHERE seq = 1""")
def mon_row_count_change(spark, sf_dir):
    return _monitor(spark, sf_dir).filter("check_name = 'row_count_change'").select(
        "run_date", "passed", "value", "threshold", "message"
    )


@query("mon_null_outputs", f"""WITH {_MONITOR}
SELECT run_date, passed, value, threshold, message FROM report WHERE seq = 2""")
def mon_null_outputs(spark, sf_dir):
    return _monitor(spark, sf_dir).filter("check_name = 'null_outputs'").select(
        "run_date", "passed", "value", "threshold", "message"
    )


@query("mon_range", f"""WITH {_MONITOR}
SELECT run_date, check_name, passed, value, threshold, message FROM report WHERE seq >= 3""")
def mon_range(spark, sf_dir):
    return _monitor(spark, sf_dir).filter(F.col("check_name").startswith("range_")).select(
        "run_date", "check_name", "passed", "value", "threshold", "message"
    )


@query("mon_summary", f"""WITH {_MONITOR}
SELECT 'events_score' AS project_id, run_date, count(*) AS n_checks, count(*) FILTER (NOT passed) AS n_failed,
       count(*) FILTER (NOT passed) = 0 AS all_passed
FROM report GROUP BY run_date""")
def mon_summary(spark, sf_dir):
    return monitor.check_summary(_monitor(spark, sf_dir))


@query("mon_failed", f"""WITH {_MONITOR}
SELECT run_date, check_name, message FROM report WHERE NOT passed""")
def mon_failed(spark, sf_dir):
    return monitor.failed_checks(_monitor(spark, sf_dir)).select("run_date", "check_name", "message")


@query("alert_messages", f"""WITH {_MONITOR}
SELECT 'events_score' AS project_id, run_date, '#event-alerts' AS channel, 'critical' AS severity, count(*) AS n_failed,
       '[!!!] [CRITICAL] events_score — Monitoring alerts for **events_score** on `' || CAST(run_date AS VARCHAR) || '`:' || chr(10)
       || string_agg('- ' || check_name || ': ' || message, chr(10) ORDER BY seq) AS message
FROM report WHERE NOT passed GROUP BY run_date""")
def alert_messages(spark, sf_dir):
    return alerts.alert_messages(_monitor(spark, sf_dir), EVENTS.monitoring.alert_channel)


@query("alert_severity", """
SELECT event_id, severity, prefix,
       prefix || ' [' || upper(severity) || '] ' || 'user ' || user_id || ' — ' || event_type AS text
FROM (SELECT *, CASE severity WHEN 'critical' THEN '[!!!]' WHEN 'warning' THEN '[!]' WHEN 'info' THEN '[i]' ELSE '[?]' END AS prefix
      FROM (SELECT *, CASE WHEN value > 200 THEN 'critical' WHEN value > 100 THEN 'warning' WHEN value > 10 THEN 'info' ELSE 'notice' END AS severity
            FROM events))""")
def alert_severity(spark, sf_dir):
    tier = (
        F.when(F.col("value") > 200, "critical").when(F.col("value") > 100, "warning")
        .when(F.col("value") > 10, "info").otherwise("notice")
    )
    who = F.concat(F.lit("user "), F.col("user_id").cast("string"))
    return events_batch(spark, sf_dir).select(
        "event_id", tier.alias("severity"), severity_prefix(tier).alias("prefix"),
        alerts.alert_text(tier, who, F.col("event_type")).alias("text"),
    )


@query("mon_empty_day", f"""WITH {BATCH_SQL}, {RUN_LOG_SQL}
SELECT DATE '2024-03-01' AS run_date, 'row_count_change' AS check_name, false AS passed, 100.0::DOUBLE AS value,
       printf('Row count changed 100.0%% (%d -> 0, max allowed: 5.0%%)', row_count) AS message
FROM last_success ORDER BY last_success.run_date DESC LIMIT 1""")
def mon_empty_day(spark, sf_dir):
    """A day without a single row is the largest drop there is."""
    day = "2024-03-01"
    none = events_scored(spark, sf_dir).filter(F.col("run_date") == F.lit(day).cast("date"))
    report = monitor.monitor_report(none, events_run_log(spark, sf_dir), EVENTS, [day])
    return report.filter("check_name = 'row_count_change'").select("run_date", "check_name", "passed", "value", "message")
