"""Alert rows: which checks to shout about, and the text to send."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from batchgauge.functions.columns import severity_prefix


def alert_text(severity: Column, project_id: Column, message: Column) -> Column:
    """``[!!!] [CRITICAL] project — message``; an empty project leaves its part out."""
    named = F.when(F.coalesce(project_id, F.lit("")) != "", F.concat(project_id, F.lit(" — ")))
    return F.concat(
        severity_prefix(severity), F.lit(" ["), F.upper(severity), F.lit("] "),
        F.coalesce(named, F.lit("")), message,
    )


def alert_messages(report: DataFrame, channel: str = "") -> DataFrame:
    """project_id, run_date, channel, severity, n_failed, message per date with failed checks.

    The rows that come together are the failed checks of one project and day, so
    their number is bounded by the checks configured.
    """
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("seq", "check_name", "message"))),
        lambda c: F.concat(F.lit("- "), c["check_name"], F.lit(": "), c["message"]),
    )
    grouped = (
        report.filter(~F.col("passed"))
        .groupBy("project_id", "run_date")
        .agg(lines.alias("lines"), F.count("*").alias("n_failed"))
    )
    # Fixed value: the heading of a message.
    head = F.concat(
        F.lit("Monitoring alerts for **"), F.col("project_id"), F.lit("** on `"),
        F.col("run_date").cast("string"), F.lit("`:"),
    )
    severity = F.lit("critical")
    body = F.concat_ws("\n", head, F.col("lines"))
    return grouped.select(
        "project_id", "run_date", F.lit(channel).alias("channel"), severity.alias("severity"),
        "n_failed", alert_text(severity, F.col("project_id"), body).alias("message"),
    )


def drift_alerts(immediate: DataFrame, sustained: DataFrame, channel: str = "") -> DataFrame:
    """Rows as of ``alert_messages``, one per column with critical or with sustained drift."""
    now = immediate.filter(F.col("source") == "drift").select(
        "project_id", "run_date", F.lit("critical").alias("severity"),
        F.concat_ws(": ", F.col("name"), F.col("message")).alias("text"),
    )
    lasting = sustained.select(
        "project_id", "run_date", F.lit("warn").alias("severity"),
        F.concat(F.col("column"), F.lit(": drift on "), F.col("drifted_days").cast("string"), F.lit(" of the last runs")).alias("text"),
    )
    return now.unionByName(lasting).select(
        "project_id", "run_date", F.lit(channel).alias("channel"), "severity", F.lit(1).cast("long").alias("n_failed"),
        alert_text(F.col("severity"), F.col("project_id"), F.col("text")).alias("message"),
    )


def immediate_alerts(report: DataFrame, drift: DataFrame) -> DataFrame:
    """Failed health checks and critical drift as (project_id, run_date, source, name, message)."""
    health = report.filter(~F.col("passed")).select(
        "project_id", "run_date", F.lit("check").alias("source"), F.col("check_name").alias("name"), "message"
    )
    shifted = drift.filter(F.col("severity") == "critical").select(
        "project_id", "run_date", F.lit("drift").alias("source"), F.col("column").alias("name"), "message"
    )
    return health.unionByName(shifted)
