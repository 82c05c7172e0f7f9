"""What happens after scoring: monitored runs, keys across dates, labels that arrive later."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import functions as F

from batchgauge.config import CheckSpec, ColumnSpec, DriftSpec, EvalSpec, GroundTruthSpec, ModelRef, OutputSpec, Project
from batchgauge.functions.columns import logistic
from batchgauge.operators import profiles, sinks, truth
from batchgauge.operators.scoring import expression_scorer
from batchgauge.plans import jobs
from batchgauge.queries.drifts import _long_sql, _psi_sql
from batchgauge.queries.inputs import EVENTS, FEATURES, RUN_LOG_SQL, SCORED_SQL, _event_outputs, events_batch
from batchgauge.queries.registry import query, rounded, table
from batchgauge.queries.tables import _days
from batchgauge.session import scratch_folder

# Scores at 9 decimals: equal inputs then tie in every engine, whatever the last bit of its exp().
ROUNDED_SCORER = expression_scorer(lambda: {n: F.round(c, 9) for n, c in _event_outputs().items()})
#: The days that run one by one, after all earlier ones in one job.
MONITORED_DAYS = 5
WATCHED = replace(
    EVENTS, output=OutputSpec("results.watched", "append"),
    monitoring=CheckSpec(
        row_count_change_max_pct=5.0, null_output_max_pct=100.0, alert_channel="#events",
        drift=DriftSpec(enabled=True, psi_warn=0.04, psi_critical=0.06),
    ),
)


def _cells_sql(value: str) -> str:
    """The lower end of a value's cell: 128 cells of equal width between two powers of two."""
    size = f"abs({value})"
    power = f"""(CASE WHEN pow(2, floor(log2({size}))) > {size} THEN floor(log2({size})) - 1
      WHEN pow(2, floor(log2({size})) + 1) <= {size} THEN floor(log2({size})) + 1 ELSE floor(log2({size})) END)"""
    width = f"pow(2, {power} - 7)"
    return f"CASE WHEN {size} < 1e-300 THEN 0::DOUBLE ELSE floor({value} / {width}) * {width} END"


_MONITORED = SCORED_SQL + f""",
last_days AS (SELECT run_date AS target FROM (SELECT DISTINCT run_date FROM batch) ORDER BY run_date DESC LIMIT {MONITORED_DAYS}),
stored AS (SELECT run_date, round(risk, 9) AS risk, round(load, 9) AS load FROM scored), {_psi_sql(
    'SELECT target AS run_date, "column", value FROM last_days JOIN (' + _long_sql("stored", ["risk", "load"], "run_date,")
    + ") h ON h.run_date >= target - INTERVAL 30 DAY AND h.run_date < target",
    _long_sql("stored SEMI JOIN last_days ON target = run_date", ["risk", "load"], "run_date,"), "run_date,", "run_date,")},
feature_long AS ({_long_sql("batch", FEATURES, "run_date,")}),
feature_cells AS (
  SELECT run_date, "column", {_cells_sql("value")} AS cell, count(*) AS n FROM feature_long WHERE value IS NOT NULL GROUP BY ALL),
feature_both AS (
  SELECT target, "column", cell, sum(n) FILTER (run_date < target) AS ref, sum(n) FILTER (run_date = target) AS cur
  FROM feature_cells JOIN last_days ON run_date BETWEEN target - INTERVAL 30 DAY AND target GROUP BY ALL),
feature_ranked AS (
  SELECT target, "column", cell, coalesce(ref, 0) AS ref, coalesce(cur, 0) AS cur,
         coalesce(sum(ref) OVER (PARTITION BY target, "column" ORDER BY cell), 0) AS upto, sum(ref) OVER (PARTITION BY target, "column") AS total
  FROM feature_both),
feature_edges AS (
  SELECT target, "column", list_sort(list_distinct([{", ".join(
      f"min(cell) FILTER (upto * 10 >= total * {i})" for i in range(1, 10))}])) AS cuts
  FROM feature_ranked WHERE total > 0 GROUP BY ALL),
feature_bins AS (
  SELECT target, "column", len(list_filter(cuts, lambda e: e <= cell)) AS bin, sum(ref) AS ref, sum(cur) AS cur
  FROM feature_ranked JOIN feature_edges USING (target, "column") GROUP BY ALL),
feature_frame AS (
  SELECT target, "column", unnest(range(0, len(cuts) + 1)) AS bin FROM feature_edges),
feature_shares AS (
  SELECT target, "column", coalesce(ref, 0) / sum(ref) OVER (PARTITION BY target, "column") + 0.0001 AS rs,
         coalesce(cur, 0) / sum(cur) OVER (PARTITION BY target, "column") + 0.0001 AS cs
  FROM feature_frame LEFT JOIN feature_bins USING (target, "column", bin)),
drifted AS (
  SELECT run_date, "column", psi FROM psi
  UNION ALL SELECT target, "column", sum((cs - rs) * ln(cs / rs)) FROM feature_shares GROUP BY target, "column"),
drift AS (
  SELECT run_date, "column" AS name, round(psi, 4) AS value,
         CASE WHEN psi >= 0.06 THEN 'critical' WHEN psi >= 0.04 THEN 'warn' ELSE 'none' END AS state FROM drifted),
lasting AS (
  SELECT run_date, name, sum(CASE WHEN state <> 'none' THEN 1 ELSE 0 END)
    OVER (PARTITION BY name ORDER BY run_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS days FROM drift),
counts AS (SELECT run_date, count(*) AS n, count(*) FILTER (risk IS NULL) + count(*) FILTER (load IS NULL) AS missing FROM scored GROUP BY run_date),
watched AS (SELECT *, lag(n) OVER (ORDER BY run_date) AS prev FROM counts),
checks AS (
  SELECT run_date, 'row_count_change' AS name, coalesce(round(abs(n - prev) * 1.0 / prev * 100, 1), n) AS value,
         CASE WHEN prev IS NULL OR abs(n - prev) * 1.0 / prev * 100 <= 5 THEN 'passed' ELSE 'failed' END AS state
  FROM watched SEMI JOIN last_days ON target = run_date
  UNION ALL
  SELECT run_date, 'null_outputs', round(missing * 100.0 / (2 * n), 2), 'passed' FROM watched SEMI JOIN last_days ON target = run_date)"""


@query("monitored_run_logs", f"""WITH {_MONITORED},
alerts AS (
  SELECT run_date, 'critical' AS name FROM checks WHERE state = 'failed'
  UNION ALL SELECT run_date, 'critical' FROM drift WHERE state = 'critical'
  UNION ALL SELECT run_date, 'warn' FROM lasting WHERE days >= 3)
SELECT 'check' AS log, run_date, name, CAST(value AS DOUBLE) AS value, state FROM checks
UNION ALL SELECT 'drift', run_date, name, value, state FROM drift
UNION ALL SELECT 'alert', run_date, name, CAST(count(*) AS DOUBLE), 'sent' FROM alerts GROUP BY run_date, name""")
def monitored_run_logs(spark, sf_dir):
    """The logs of the last days, run one by one over the history of all earlier ones; the last day runs twice."""
    store, batch = sinks.Store(spark, scratch_folder(spark, "watched")), events_batch(spark, sf_dir)
    days = [r[0] for r in batch.select("run_date").distinct().orderBy("run_date").collect()]
    first, last = days[:-MONITORED_DAYS], days[-MONITORED_DAYS:]
    if first:
        jobs.backfill(spark, store, WATCHED, ROUNDED_SCORER, first[0], first[-1], batch)
    for day in [*last, last[-1]]:
        project = WATCHED.with_write_mode("replace_date")
        jobs.daily_run(spark, store, project, ROUNDED_SCORER, day, batch.filter(F.col("run_date") == F.lit(day)), with_monitoring=True)
    latest = lambda name: profiles.latest_rows(store.read(name), ["run_date"])
    checks = latest("monitoring_log").select(
        F.lit("check").alias("log"), "run_date", F.col("check_name").alias("name"), "value",
        F.when(F.col("passed"), "passed").otherwise("failed").alias("state"),
    )
    found = latest("drift_log").select(
        F.lit("drift").alias("log"), "run_date", F.col("column").alias("name"), F.col("psi").alias("value"), F.col("severity").alias("state")
    )
    alerts = latest("alert_log").groupBy("run_date", F.col("severity").alias("name")).agg(F.count("*").cast("double").alias("value")).select(
        F.lit("alert").alias("log"), "run_date", "name", "value", F.lit("sent").alias("state")
    )
    return checks.unionByName(found).unionByName(alerts)


@query("feature_log_cells", f"""WITH {SCORED_SQL}, cells AS ({_long_sql("batch", FEATURES, "run_date,")})
SELECT run_date, "column", {_cells_sql("value")} AS cell, count(*) AS n FROM cells GROUP BY ALL""")
def feature_log_cells(spark, sf_dir):
    """The cells that a day's features leave in the log, for all days at once."""
    return profiles.feature_cells(events_batch(spark, sf_dir), FEATURES)


UNIQUE = replace(
    EVENTS, output=OutputSpec("results.unique", "append", ("user_id",), "table"), monitoring=CheckSpec(null_output_max_pct=100.0),
    schema=replace(EVENTS.schema, id_columns=("event_id", "user_id")),
)


@query("save_unseen_keys", f"""WITH {SCORED_SQL}
SELECT event_id, user_id, run_date FROM (
  SELECT event_id, user_id, run_date, row_number() OVER (PARTITION BY user_id ORDER BY run_date, event_id DESC) AS rn FROM batch)
WHERE rn = 1""")
def save_unseen_keys(spark, sf_dir):
    """One row per user in the whole table: the later half of the days brings only users that the earlier half has not."""
    store, batch = sinks.Store(spark, scratch_folder(spark, "unique")), events_batch(spark, sf_dir)
    days = _days(batch)
    middle = days[len(days) // 2]
    jobs.backfill(spark, store, UNIQUE, ROUNDED_SCORER, days[0], middle, batch)
    jobs.backfill(spark, store, UNIQUE, ROUNDED_SCORER, middle + timedelta(days=1), days[-1], batch)
    return store.read("results.unique").select("event_id", "user_id", "run_date")


# Documents as a scored table of a week; labels come 14 days later, two thirds of them first, the rest late.
JUDGED = Project(
    project_id="doc_quality", model=ModelRef("doc_quality"),
    schema=ColumnSpec(("doc_id",), ("n_chars",), ("score",)), output=OutputSpec("results.docs", "append"),
    monitoring=CheckSpec(null_output_max_pct=100.0),
    evaluation=EvalSpec(
        ("auc_roc", "ks_statistic", "accuracy", "f1_macro", "mse", "log_loss"), {"auc_roc": 0.5, "accuracy": 0.5, "log_loss": 0.7},
        GroundTruthSpec("sql", "SELECT doc_id, quality, label_date FROM batchgauge_labels WHERE arrived = '{run_date}'", "quality", 14),
    ),
)
ARRIVALS = (date(2024, 1, 25), date(2024, 2, 2))
DOC_SCORER = expression_scorer(lambda: {"score": F.round(logistic(F.ln(F.col("n_chars") + 1) - 6), 9)})
_TRUTH = """
docs AS (
  SELECT doc_id, DATE '2024-01-01' + CAST(doc_id % 7 AS INT) AS run_date, round(1 / (1 + exp(-(ln(n_chars + 1) - 6))), 9) AS score
  FROM documents),
-- a label of the wrong date belongs to no scored row
truth AS (
  SELECT run_date, quality AS y, score, round(score, 4) AS cell, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted
  FROM docs JOIN labels USING (doc_id) WHERE doc_id % 11 <> 0),
tied AS (
  SELECT run_date, cell, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM truth GROUP BY ALL),
prefix AS (
  SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, nullif(sum(pos) OVER (PARTITION BY run_date), 0) AS np,
         nullif(sum(neg) OVER (PARTITION BY run_date), 0) AS nn
  FROM tied WINDOW w AS (PARTITION BY run_date ORDER BY cell)),
ranked AS (
  SELECT run_date, sum(pos * (cn - neg + neg / 2)) / (max(np)::DOUBLE * max(nn)) AS auc, coalesce(max(abs(cp / np - cn / nn)), 0) AS ks
  FROM prefix GROUP BY run_date),
plain AS (
  SELECT run_date, count(*) AS n, avg(CAST(y = predicted AS INT)) AS accuracy, avg((y - predicted) * (y - predicted)) AS mse,
         CASE WHEN min(y) <> max(y) THEN avg(-ln(CASE WHEN y = 1 THEN score ELSE 1 - score END)) END AS log_loss,
         count(*) FILTER (y = 1 AND predicted = 1) AS tp, count(*) FILTER (y = 0 AND predicted = 1) AS fp,
         count(*) FILTER (y = 1 AND predicted = 0) AS fn, count(*) FILTER (y = 0 AND predicted = 0) AS tn
  FROM truth GROUP BY run_date),
f1 AS (
  SELECT run_date, (coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0))
           / (CASE WHEN tp + fp + fn > 0 THEN 1 ELSE 0 END + CASE WHEN tn + fp + fn > 0 THEN 1 ELSE 0 END) AS f1_macro FROM plain),
long AS (
  SELECT run_date, n, 'auc_roc' AS metric, round(auc, 6) AS value, 0.5::DOUBLE AS threshold, false AS lower FROM plain JOIN ranked USING (run_date)
  UNION ALL SELECT run_date, n, 'ks_statistic', round(ks, 6), NULL, false FROM plain JOIN ranked USING (run_date)
  UNION ALL SELECT run_date, n, 'accuracy', round(accuracy, 6), 0.5, false FROM plain
  UNION ALL SELECT run_date, n, 'f1_macro', round(f1_macro, 6), NULL, false FROM plain JOIN f1 USING (run_date)
  UNION ALL SELECT run_date, n, 'mse', round(mse, 6), NULL, false FROM plain
  UNION ALL SELECT run_date, n, 'log_loss', round(log_loss, 6), 0.7, true FROM plain)"""


def _judged_store(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.date_add(F.lit(date(2024, 1, 1)), (F.col("doc_id") % 7).cast("int")).alias("run_date")
    )
    store = sinks.Store(spark, scratch_folder(spark, "judged"))
    jobs.backfill(spark, store, JUDGED, DOC_SCORER, "2024-01-01", "2024-01-07", docs)
    late, lost = F.col("doc_id") % 3 == 2, F.col("doc_id") % 11 == 0
    table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "doc_id", "quality", F.date_add("run_date", F.when(lost, 13).otherwise(14)).alias("label_date"),
        F.when(late, F.lit(ARRIVALS[1])).otherwise(F.lit(ARRIVALS[0])).alias("arrived"),
    ).createOrReplaceTempView("batchgauge_labels")
    for day in (*ARRIVALS, ARRIVALS[0]):  # the first arrival is taken twice
        jobs.take_truth(spark, store, JUDGED, day)
    return store


@query("quality_over_time", f"""WITH {_TRUTH}
SELECT run_date, n AS n_labelled, metric, value, threshold,
       CASE WHEN threshold IS NOT NULL THEN coalesce(CASE WHEN lower THEN value <= threshold ELSE value >= threshold END, false) END AS passed
FROM long""")
def quality_over_time(spark, sf_dir):
    """Metrics by date from labels of two arrivals, by the settings' lag."""
    return truth.quality_over_time(_judged_store(spark, sf_dir), JUDGED)


@query("label_backlog", f"""WITH {_TRUTH},
scored AS (SELECT run_date, count(*) AS n_scored FROM docs GROUP BY run_date),
done AS (SELECT run_date, count(*) AS n FROM truth GROUP BY run_date)
SELECT run_date, n_scored, coalesce(n, 0) AS n_labelled, run_date + 14 AS due_on,
       coalesce(n, 0) < n_scored AND run_date + 14 <= DATE '2024-01-18' AS overdue
FROM scored LEFT JOIN done USING (run_date)""")
def label_backlog(spark, sf_dir):
    return truth.label_backlog(_judged_store(spark, sf_dir), JUDGED, date(2024, 1, 18))


@query("sink_run_date_added", f"""WITH {SCORED_SQL}
SELECT event_id, DATE '2024-02-01' AS run_date, round(risk, 6) AS risk FROM scored""")
def sink_run_date_added(spark, sf_dir):
    """A batch without a date column gets the date it is saved for."""
    store = sinks.Store(spark, scratch_folder(spark, "dated"))
    scored = events_batch(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in _event_outputs().items()])
    sinks.save(store, scored, replace(EVENTS, output=OutputSpec("results.dated", "append")), "2024-02-01")
    return store.read("results.dated").select("event_id", "run_date", "risk").withColumns(rounded("risk"))
