"""Health checks after scoring, for any number of dates in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchgauge.config import Project
from batchgauge.functions.columns import missing, outside

# The texts of the checks, with their number formats.
NO_PREVIOUS = "No previous run to compare (count=%d)"
COUNT_TEXT = "Row count changed %.1f%% (%d -> %d, max allowed: %s%%)"
NO_CELLS = "No output cells to check"
NULL_TEXT = "%.2f%% NaN in output columns (max: %s%%)"
NO_VALUES = "No non-null values in '%s'"
RANGE_TEXT = "%d/%d values outside [%s, %s] (%.2f%%)"


def last_success(run_log: DataFrame) -> DataFrame:
    """(project_id, run_date, row_count): the last successful run of each date."""
    return (
        run_log.filter(F.col("status") == "success")
        .groupBy("project_id", "run_date")
        .agg(F.max(F.struct("created_at", "row_count"))["row_count"].alias("row_count"))
    )


def previous_count(current: DataFrame, run_log: DataFrame) -> DataFrame:
    """``current`` (project_id, run_date, …) plus previous_count, as of the day before.

    Log rows and current rows share one window per project over days, so nothing is
    joined; the log holds at most one row per project and day by then.
    """
    names = current.columns
    rows = current.select(
        "project_id", "run_date", F.struct(*names).alias("row"), F.lit(None).cast("long").alias("logged")
    )
    logged = last_success(run_log).select(
        "project_id", "run_date", F.lit(None).cast(rows.schema["row"].dataType).alias("row"),
        F.col("row_count").cast("long").alias("logged"),
    )
    before = (
        Window.partitionBy("project_id").orderBy(F.unix_date("run_date"))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.unionByName(logged)
        .withColumn("previous_count", F.last("logged", ignorenulls=True).over(before))
        .filter(F.col("row").isNotNull())
        .select("row.*", "previous_count")
    )


def run_counts(result: DataFrame, project: Project) -> DataFrame:
    """(project_id, run_date, n_rows, missing cells, in/out of range counts): one aggregate."""
    outputs = project.schema.output_columns
    cells = [F.sum(missing(result, c).cast("long")) for c in outputs]
    null_cells = sum(cells[1:], cells[0]) if cells else F.lit(0)
    ranges = []
    for i, (name, (low, high)) in enumerate(project.monitoring.prediction_range.items()):
        if name in result.columns:
            ranges += [
                F.count_if(~missing(result, name)).alias(f"present_{i}"),
                F.count_if(outside(result, name, low, high)).alias(f"outside_{i}"),
            ]
    return (
        result.groupBy("run_date")
        .agg(F.count("*").alias("n_rows"), null_cells.alias("null_cells"), *ranges)
        .withColumn("project_id", F.lit(project.project_id))
    )


def _result(seq: int, name: str, passed: Column, value: Column, threshold, message: Column) -> Column:
    return F.struct(
        F.lit(seq).alias("seq"),
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        value.cast("double").alias("value"),
        (threshold if isinstance(threshold, Column) else F.lit(threshold)).cast("double").alias("threshold"),
        message.alias("message"),
    )


def row_count_check(max_pct: float) -> Column:
    """The ``row_count_change`` result of a row with n_rows and previous_count."""
    current, before = F.col("n_rows"), F.col("previous_count")
    pct = F.abs(current - before) / F.nullif(before, F.lit(0)) * 100
    return _result(
        1, "row_count_change",
        pct.isNull() | (pct <= F.lit(float(max_pct))),
        F.when(pct.isNull(), current.cast("double")).otherwise(F.round(pct, 1)),
        float(max_pct),
        F.when(pct.isNull(), F.format_string(NO_PREVIOUS, current))
        .otherwise(F.format_string(COUNT_TEXT, pct, before, current, F.lit(str(max_pct)))),
    )


def null_outputs_check(n_outputs: int, max_pct: float) -> Column:
    """Missing cells over all output columns together."""
    cells = F.col("n_rows") * n_outputs
    pct = F.col("null_cells") * F.lit(100.0) / F.nullif(cells, F.lit(0))
    return _result(
        2, "null_outputs",
        pct.isNull() | (pct <= F.lit(float(max_pct))),
        F.coalesce(F.round(pct, 2), F.lit(0.0)),
        float(max_pct),
        F.when(pct.isNull(), F.lit(NO_CELLS)).otherwise(F.format_string(NULL_TEXT, pct, F.lit(str(max_pct)))),
    )


def range_check(seq: int, i: int, name: str, low: float, high: float) -> Column:
    present, out = F.col(f"present_{i}"), F.col(f"outside_{i}")
    pct = out * F.lit(100.0) / F.nullif(present, F.lit(0))
    return _result(
        seq, f"range_{name}", out == 0, F.round(pct, 2), F.when(pct.isNotNull(), F.lit(0.0)),
        F.when(pct.isNull(), F.lit(NO_VALUES % name)).otherwise(
            F.format_string(RANGE_TEXT, out, present, F.lit(str(low)), F.lit(str(high)), pct)
        ),
    )


def _with_empty_days(counts: DataFrame, project: Project, dates: Sequence[str | date]) -> DataFrame:
    """``counts`` with a row of zeros for each asked date that has none."""
    days = counts.sparkSession.createDataFrame(
        [(date.fromisoformat(str(d)),) for d in dict.fromkeys(dates)], "run_date date"
    )
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in counts.columns if c not in ("run_date", "project_id")}
    return (
        counts.join(days, "run_date", "full").withColumns(zeros)
        .withColumn("project_id", F.lit(project.project_id)).select(*counts.columns)
    )


def monitor_report(
    result: DataFrame, run_log: DataFrame, project: Project, dates: Sequence[str | date] | None = None
) -> DataFrame:
    """project_id, run_date, seq, check_name, passed, value, threshold, message per check.

    Every date of ``dates`` is reported, also one without a single row.
    """
    checks = project.monitoring
    counts = run_counts(result, project)
    if dates is not None:
        counts = _with_empty_days(counts, project, dates)
    out = [
        row_count_check(checks.row_count_change_max_pct),
        null_outputs_check(len(project.schema.output_columns), checks.null_output_max_pct),
    ]
    for i, (name, (low, high)) in enumerate(checks.prediction_range.items()):
        if f"outside_{i}" in counts.columns:
            out.append(range_check(3 + i, i, name, low, high))
    return previous_count(counts, run_log).select("project_id", "run_date", F.inline(F.array(*out)))


def failed_checks(report: DataFrame) -> DataFrame:
    return report.filter(~F.col("passed"))


def check_summary(report: DataFrame) -> DataFrame:
    """project_id, run_date, n_checks, n_failed and all_passed."""
    failed = F.count_if(~F.col("passed"))
    return report.groupBy("project_id", "run_date").agg(
        F.count("*").alias("n_checks"), failed.alias("n_failed"), (failed == 0).alias("all_passed")
    )
