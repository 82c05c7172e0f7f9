"""The daily run, the one-job backfill, and runs over all active projects."""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from batchgauge.config import Project, metric_findings
from batchgauge.functions.columns import col
from batchgauge.operators import alerts, drift, gates, lookups, monitor, profiles, sinks, truth
from batchgauge.operators.scoring import Scorer, scored_batch
from batchgauge.sources import readers


#: Runs that decide whether drift lasts.
DRIFT_RUNS = 5


def scored_input(batch: DataFrame, project: Project, scorer: Scorer, run_date: str | date) -> DataFrame:
    """Check the input's structure, then score it. No rows are read but one."""
    gates.check_input(batch, project.schema)
    return scored_batch(batch, scorer, project.schema, run_date)


def daily_run(
    spark: SparkSession, store: sinks.Store, project: Project, scorer: Scorer, run_date: str | date,
    batch: DataFrame | None = None, with_monitoring: bool = False, reference: DataFrame | None = None,
) -> str:
    """Read, check, score, check, save and log one date: 'success' or 'skipped'.

    A failure is logged and raised again. With monitoring, health checks, drift against
    ``reference`` and the alert rows follow the save.
    """
    started, day = time.monotonic(), date.fromisoformat(str(run_date))
    store.ensure_platform_tables()
    scored, logged = None, False
    try:
        batch = readers.fetch(spark, project.input, day) if batch is None else batch
        # Gates and write share the narrow scored rows; a lost block is computed again.
        scored = scored_input(batch, project, scorer, day).persist(StorageLevel.MEMORY_AND_DISK)
        gates.check_output(scored, project.schema, project.monitoring)
        status = sinks.save_dates(store, scored, project, [day])[day]
        rows = 0
        if status == "success":
            rows = store.result(project, scored.schema).filter(F.col("run_date") == F.lit(day)).count()
        sinks.log_run(store, project, day, status, rows, time.monotonic() - started)
        logged = True
        if with_monitoring:
            try:
                after_run(store, project, scored, day, batch, reference)
            except Exception as e:  # the rows are saved and logged: what watches them only warns
                warnings.warn(f"monitoring of {project.project_id} on {day} failed: {e}", stacklevel=2)
        return status
    except Exception as e:
        if not logged:
            sinks.log_run(store, project, day, "failed", 0, time.monotonic() - started, str(e))
        raise
    finally:
        if scored is not None:
            scored.unpersist()


def after_run(
    store: sinks.Store, project: Project, scored: DataFrame, run_date: date,
    batch: DataFrame | None = None, reference: DataFrame | None = None, created_at: datetime | None = None,
) -> dict[str, DataFrame]:
    """Write the health checks, alerts and drift of a date to their logs; the same rows by name.

    Outputs are held against ``reference`` or, without one, against the stored scores of the days that the drift settings
    name; features against ``reference`` where it has them, else against the feature log of those days, to
    which this day's cells are added. Critical drift, and drift on most of the last runs, are alerts too. All
    rows of a run carry one time: a date that ran again counts by its last run.
    """
    stamp = F.lit(created_at or datetime.now(timezone.utc)).cast("timestamp")
    own_runs = store.read("run_log").filter(F.col("project_id") == project.project_id)
    report = monitor.monitor_report(scored, own_runs, project, [run_date])
    sinks.log_checks(store, report, created_at)
    out = {"report": report, "alerts": alerts.alert_messages(report, project.monitoring.alert_channel)}
    store.append_log("alert_log", out["alerts"].withColumn("created_at", stamp))
    spec, features = project.monitoring.drift, project.schema.feature_columns
    parts = []
    if spec.enabled and batch is not None:
        profiles.log_features(store, project, batch, stamp, F.lit(run_date))
        logged = [c for c in features if reference is None or c not in reference.columns]
        if logged:
            found = profiles.drift_from_log(store.read("feature_log"), project, [run_date], logged, spec)
            parts.append(found.drop("run_date"))
        if reference is not None:
            parts.append(drift.drift_check(batch, reference, features, spec))
    if spec.enabled and reference is None:
        stored = drift.reference_window(store.result(project, scored.schema), run_date, spec.reference_days)
        reference = None if stored.isEmpty() else stored
    if reference is not None:
        parts.append(drift.drift_check(scored, reference, project.schema.output_columns, spec))
    if not parts:
        return out
    rows = reduce(DataFrame.unionByName, parts)
    out["drift"] = rows.select(
        F.lit(project.project_id).alias("project_id"), F.lit(run_date).alias("run_date"), *rows.columns
    )
    store.append_log("drift_log", out["drift"].withColumn("created_at", stamp))
    # from here on from the log: a few rows per day, of the last days only
    past = store.read("drift_log").filter((F.col("project_id") == project.project_id) & (F.col("run_date") <= F.lit(run_date)))
    last = [r[0] for r in past.select("run_date").distinct().orderBy(F.desc("run_date")).limit(DRIFT_RUNS).collect()]
    past = profiles.latest_rows(past.filter(F.col("run_date").isin(last)), ["project_id", "run_date"])
    today = F.col("run_date") == F.lit(run_date)
    out["immediate"] = alerts.immediate_alerts(report, past.filter(today))
    out["sustained"] = drift.sustained_drift(past, of_last=DRIFT_RUNS).filter(today & F.col("sustained"))
    store.append_log("alert_log", alerts.drift_alerts(
        out["immediate"], out["sustained"], project.monitoring.alert_channel
    ).withColumn("created_at", stamp))
    return out


def calendar(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """run_date for every day from start to end, both included."""
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    return spark.range((last - first).days + 1 if last >= first else 0).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("run_date")
    )


def gate_outcomes(
    batch: DataFrame, scored: DataFrame, project: Project, days: DataFrame
) -> DataFrame:
    """run_date, n_rows, error, message: the first failing gate of each day, or NULL.

    A day without input rows fails the input gate. One aggregate covers all days.
    """
    problem = None
    for names, kind in ((project.schema.id_columns, "id_columns"), (project.schema.feature_columns, "feature_columns")):
        problem = problem or gates.absent_columns(batch, names, kind)
    report = gates.output_report(scored, project.schema, project.monitoring, ["run_date"])
    # The report has a few rows per day: all that is left of the batch.
    first = report.groupBy("run_date").agg(
        F.max(F.when(F.col("check_name") == "not_empty", F.col("value"))).cast("long").alias("n_rows"),
        F.min_by("message", F.when(~F.col("passed"), F.col("seq"))).alias("message"),
        F.min_by("error", F.when(~F.col("passed"), F.col("seq"))).alias("error"),
    )
    none = F.col("n_rows").isNull()
    structural = none | F.lit(problem is not None)
    message = F.when(none, F.lit(gates.EMPTY_INPUT)).otherwise(F.coalesce(F.lit(problem), F.col("message")))
    return days.join(first, "run_date", "left").select(
        "run_date", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.when(structural, F.lit("ValidationError")).otherwise(F.col("error")).alias("error"),
        message.alias("message"),
    )


def backfill(
    spark: SparkSession, store: sinks.Store, project: Project, scorer: Scorer,
    start: str | date, end: str | date, batch: DataFrame | None = None, day: str = "run_date",
    replace: bool = False,
) -> DataFrame:
    """Score every day from start to end: run_date, status, row_count, error_message.

    With a source that holds all days (``batch``, dated by column ``day``) this is one
    job: score, one aggregate of gates per day, one write of the days that pass, one
    append to the run log, and, where drift is watched, one of the features' cells. A source templated by date is run day by day, and so is a
    range in which the scorer raises. A day that fails does not stop the others.
    """
    if replace:
        project = project.with_write_mode("replace_date")
    store.ensure_platform_tables()
    if batch is None and readers.is_templated(project.input):
        return _day_by_day(spark, store, project, scorer, start, end)
    started = time.monotonic()
    batch = readers.fetch(spark, project.input, start) if batch is None else batch
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    in_range = batch.filter(col(day).cast("date").between(F.lit(first), F.lit(last)))
    days = calendar(spark, first, last)
    absent = [c for c in (*project.schema.id_columns, *project.schema.feature_columns) if c not in batch.columns]
    if absent:
        problem = gates.absent_columns(batch, project.schema.id_columns, "id_columns")
        problem = problem or gates.absent_columns(batch, project.schema.feature_columns, "feature_columns")
        counts = in_range.groupBy(col(day).cast("date").alias("run_date")).agg(F.count("*").alias("n"))
        text = F.when(F.col("n") > 0, F.lit(problem)).otherwise(F.lit(gates.EMPTY_INPUT))
        verdicts = [(r["run_date"], 0, r["message"]) for r in
                    days.join(counts, "run_date", "left").select("run_date", text.alias("message")).collect()]
        return _finish(spark, store, project, verdicts, {}, started)
    scored = scored_batch(in_range, scorer, project.schema, col(day)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store.ensure_result_table(project, scored.schema)
        try:
            # Collected: one row per calendar day.
            outcome = gate_outcomes(in_range, scored, project, days).collect()
        except Exception as e:  # nothing is saved yet: find the day by itself
            warnings.warn(f"one-job backfill of {project.project_id} failed, going day by day: {e}", stacklevel=2)
            return _day_by_day(spark, store, project, scorer, first, last, batch, day)
        verdicts = [(r["run_date"], r["n_rows"], r["message"]) for r in outcome]
        passing = [d for d, _, message in verdicts if message is None]
        status = sinks.save_dates(store, scored, project, passing) if passing else {}
        if project.output.dedup_key and passing:
            saved = store.result(project, scored.schema).filter(F.col("run_date").isin(passing))
            kept = {r["run_date"]: r["count"] for r in saved.groupBy("run_date").count().collect()}
            verdicts = [(d, kept.get(d, n), m) for d, n, m in verdicts]
        written = [d for d in passing if status[d] == "success"]
        if project.monitoring.drift.enabled and written:
            fresh = in_range.withColumn("run_date", col(day).cast("date")).filter(F.col("run_date").isin(written))
            profiles.log_features(store, project, fresh, F.lit(datetime.now(timezone.utc)).cast("timestamp"))
        return _finish(spark, store, project, verdicts, status, started)
    finally:
        scored.unpersist()


def _finish(
    spark: SparkSession, store: sinks.Store, project: Project,
    verdicts: Sequence[tuple[date, int, str | None]], status: Mapping[date, str], started: float,
) -> DataFrame:
    """Log the outcome of every day in one append, and return it."""
    took = time.monotonic() - started
    rows = []
    for day, n, message in sorted(verdicts, key=lambda v: v[0]):
        state = "failed" if message is not None else status[day]
        rows.append((project.project_id, day, state, n if state == "success" else 0, took, message))
    if rows:
        store.append_log("run_log", sinks.run_rows(spark, rows))
    outcome = [(day, state, n, message) for _, day, state, n, _, message in rows]
    return spark.createDataFrame(outcome, "run_date date, status string, row_count long, error_message string")


def _day_by_day(spark, store, project, scorer, start, end, batch: DataFrame | None = None, dated: str = "run_date") -> DataFrame:
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    outcome = []
    for offset in range((last - first).days + 1):
        day = first + timedelta(days=offset)
        rows = None if batch is None else batch.filter(col(dated).cast("date") == F.lit(day))
        try:
            state, message = daily_run(spark, store, project, scorer, day, rows), None
        except Exception as e:  # one day's failure is its own
            state, message = "failed", str(e)
        outcome.append((day, state, message))
    rows = spark.createDataFrame(outcome, "run_date date, status string, error_message string")
    logged = monitor.last_success(store.read("run_log").filter(F.col("project_id") == project.project_id))
    written = F.when(F.col("status") == "success", F.col("row_count")).otherwise(F.lit(0))
    return rows.join(logged.select("run_date", "row_count"), "run_date", "left").select(
        "run_date", "status", written.alias("row_count"), "error_message"
    )


def run_active(
    spark: SparkSession, store: sinks.Store, projects: Mapping[str, Project], registry: DataFrame,
    scorers: Mapping[str, Scorer], run_date: str | date,
    run: Callable[..., str] = daily_run,
) -> dict[str, str]:
    """One independent run per active project of the registry: project -> status or error."""
    out = {}
    for row in lookups.active_projects(registry).select("project_id").collect():
        name = row["project_id"]
        try:
            out[name] = run(spark, store, projects[name], scorers[name], run_date)
        except Exception as e:  # a failing project does not stop the others
            out[name] = str(e)
    return out


def dry_run(
    spark: SparkSession, project: Project, scorer: Scorer, run_date: str | date, batch: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scored, preview of 10 rows, output stats) of a date, checked but not written."""
    batch = readers.fetch(spark, project.input, run_date) if batch is None else batch
    scored = scored_input(batch, project, scorer, run_date)
    gates.check_output(scored, project.schema, project.monitoring)
    preview = scored.orderBy(*[col(c) for c in project.schema.id_columns]).limit(10)
    return scored, preview, gates.output_stats(scored, project.schema.output_columns)


def preflight(
    spark: SparkSession, project: Project, scorer: Scorer, run_date: str | date | None = None,
    batch: DataFrame | None = None,
) -> list[str]:
    """Problems of source, columns, scores and metric settings; an empty list is a pass."""
    day = date.today() if run_date is None else date.fromisoformat(str(run_date))
    settings = metric_findings(project.evaluation.metrics, project.evaluation.thresholds)
    problems = [message for _, usable, message in settings if not usable]
    try:
        batch = readers.fetch(spark, project.input, day) if batch is None else batch
    except Exception as e:  # reported, not raised
        return [*problems, f"the input cannot be read: {e}"]
    absent = sorted({*project.schema.id_columns, *project.schema.feature_columns} - set(batch.columns))
    if absent:
        problems.append(f"the input lacks {absent}")
    if batch.isEmpty():
        problems.append(f"the input of {day} is empty")
    elif not absent:
        try:
            scored = scored_batch(batch, scorer, project.schema, day)
            gates.check_output(scored, project.schema, project.monitoring)
        except Exception as e:  # reported, not raised
            problems.append(f"a trial scoring did not pass: {e}")
    return problems


def take_truth(
    spark: SparkSession, store: sinks.Store, project: Project, as_of: str | date, prediction: str | None = None,
    score: str | None = None, labels: DataFrame | None = None,
) -> DataFrame:
    """Read the labels that arrive on a day from the source that the settings name, and update the dates they belong to.

    Returns the metrics of all labelled dates (``truth.quality_over_time``).
    """
    spec = project.evaluation.ground_truth
    if spec is None:
        raise ValueError(f"{project.project_id} names no ground truth")
    day = date.fromisoformat(str(as_of))
    if labels is None:
        labels = readers.fetch(spark, replace(project.input, source=spec.source, query=spec.query), day)
    truth.add_labels(store, project, labels, day, prediction, score)
    return truth.quality_over_time(store, project)
