"""Population stability and its alert tiers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from batchgauge.config import DriftSpec
from batchgauge.operators import alerts, drift
from batchgauge.queries.checks import _MONITOR, _monitor
from batchgauge.queries.inputs import (
    BATCH_SQL, EVENTS, FEATURES, SCORED_SQL, events_batch, events_scored,
)
from batchgauge.queries.registry import query, rounded

SPLIT = "2024-01-16"
ON = DriftSpec(enabled=True)


def _long_sql(source: str, names: list[str], keys: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT {keys} '{n}' AS "column", CAST({n} AS DOUBLE) AS value FROM {source}""" for n in names
    )


def _psi_sql(ref: str, cur: str, key: str = "", ref_key: str = "") -> str:
    """CTE ``psi`` (key, column, psi) from long relations; key names end in a comma."""
    using = f'({ref_key} "column")'
    return f"""
ref_long AS ({ref}),
cur_long AS ({cur}),
edges AS (
  SELECT {ref_key} "column",
         list_sort(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS cuts
  FROM ref_long WHERE value IS NOT NULL GROUP BY ALL),
ref_bins AS (
  SELECT {ref_key} "column", len(list_filter(cuts, lambda e: e <= value)) AS bin, count(*) AS n
  FROM ref_long JOIN edges USING {using} WHERE value IS NOT NULL GROUP BY ALL),
cur_bins AS (
  SELECT {key} "column", len(list_filter(cuts, lambda e: e <= value)) AS bin, count(*) AS n
  FROM cur_long JOIN edges USING {using} WHERE value IS NOT NULL GROUP BY ALL),
ref_all AS (SELECT {ref_key} "column", sum(n) AS total FROM ref_bins GROUP BY ALL),
cur_all AS (SELECT {key} "column", sum(n) AS total FROM cur_bins GROUP BY ALL),
frame AS (
  SELECT {key} "column", unnest(range(0, len(cuts) + 1)) AS bin, c.total AS cur_n, r.total AS ref_n
  FROM cur_all c JOIN edges USING {using} JOIN ref_all r USING {using}),
shares AS (
  SELECT {key} "column", coalesce(c.n, 0) / cur_n + 0.0001 AS cs, coalesce(r.n, 0) / ref_n + 0.0001 AS rs
  FROM frame LEFT JOIN cur_bins c USING ({key} "column", bin) LEFT JOIN ref_bins r USING ({ref_key} "column", bin)),
psi AS (SELECT {key} "column", sum((cs - rs) * ln(cs / rs)) AS psi FROM shares GROUP BY ALL)"""


_GRADED = """
SELECT "column", round(psi, 4) AS psi,
       CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.1 THEN 'warn' ELSE 'none' END AS severity FROM psi"""


def _halves(df):
    early = F.col("run_date") < F.lit(SPLIT).cast("date")
    return df.filter(early), df.filter(~early)


@query("psi_single", f"""WITH {BATCH_SQL}, {_psi_sql(
    _long_sql(f"batch WHERE run_date < DATE '{SPLIT}'", ["value"]),
    _long_sql(f"batch WHERE run_date >= DATE '{SPLIT}'", ["value"]))}
SELECT "column", round(psi, 6) AS psi FROM psi""")
def psi_single(spark, sf_dir):
    reference, current = _halves(events_batch(spark, sf_dir))
    return drift.psi(reference, current, ["value"]).withColumns(rounded("psi"))


@query("psi_all_features", f"""WITH {BATCH_SQL}, {_psi_sql(
    _long_sql(f"batch WHERE run_date < DATE '{SPLIT}'", FEATURES),
    _long_sql(f"batch WHERE run_date >= DATE '{SPLIT}'", FEATURES))}{_GRADED}""")
def psi_all_features(spark, sf_dir):
    reference, current = _halves(events_batch(spark, sf_dir))
    # event_type is not numeric and no_such_column is not there: both are skipped.
    names = [*FEATURES, "event_type", "no_such_column"]
    return drift.drift_check(current, reference, names, ON).select("column", "psi", "severity")


# Scores at 9 decimals: equal inputs then tie in every engine, whatever the last bit of its exp().
@query("psi_predictions", f"""WITH {SCORED_SQL},
stored AS (SELECT run_date, round(risk, 9) AS risk, round(load, 9) AS load FROM scored), {_psi_sql(
    _long_sql(f"stored WHERE run_date < DATE '{SPLIT}'", ["risk", "load"]),
    _long_sql(f"stored WHERE run_date >= DATE '{SPLIT}'", ["risk", "load"]))}{_GRADED}""")
def psi_predictions(spark, sf_dir):
    stored = events_scored(spark, sf_dir).withColumns(rounded("risk", "load", digits=9))
    reference, current = _halves(stored)
    return drift.drift_check(current, reference, EVENTS.schema.output_columns, ON).select("column", "psi", "severity")


@query("psi_sketch")
def psi_sketch(spark, sf_dir):
    """The one-pass version: bins from sketched deciles."""
    reference, current = _halves(events_batch(spark, sf_dir))
    return drift.psi(reference, current, FEATURES, approximate=True).withColumns(rounded("psi", digits=3))


_SHIFTED = "value * CASE \"column\" WHEN 'value' THEN 1.6 WHEN 'k' THEN 1.15 ELSE 1 END"


@query("drift_severity", f"""WITH {BATCH_SQL}, {_psi_sql(
    _long_sql(f"batch WHERE run_date < DATE '{SPLIT}'", FEATURES),
    f'SELECT "column", {_SHIFTED} AS value FROM (' + _long_sql(f"batch WHERE run_date >= DATE '{SPLIT}'", FEATURES) + ")")}
SELECT "column", round(psi, 4) AS psi,
       CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.1 THEN 'warn' ELSE 'none' END AS severity,
       printf('PSI=%.4f (%s)', round(psi, 4), CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.1 THEN 'warn' ELSE 'none' END) AS message
FROM psi""")
def drift_severity(spark, sf_dir):
    reference, current = _halves(events_batch(spark, sf_dir))
    current = current.withColumns({"value": F.col("value") * 1.6, "k": F.col("k") * F.lit(1.15)})
    return drift.drift_check(current, reference, FEATURES, ON)


@query("psi_rolling_30d", f"""WITH {BATCH_SQL},
asked AS (SELECT DISTINCT run_date AS target FROM batch), {_psi_sql(
    "SELECT target AS run_date, \"column\", value FROM asked JOIN ("
    + _long_sql("batch", FEATURES, "run_date,")
    + ") h ON h.run_date >= target - INTERVAL 30 DAY AND h.run_date < target",
    _long_sql("batch", FEATURES, "run_date,"),
    "run_date,", "run_date,")}
SELECT run_date, "column", round(coalesce(psi, 0), 4) AS psi,
       CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.1 THEN 'warn' ELSE 'none' END AS severity
FROM cur_days LEFT JOIN psi USING (run_date, "column")""".replace(
    "ref_all AS (", 'cur_days AS (SELECT DISTINCT run_date, "column" FROM cur_long),\nref_all AS ('))
def psi_rolling_30d(spark, sf_dir):
    """Every date of the table, each against the 30 days before it; the first has none."""
    batch = events_batch(spark, sf_dir)
    return drift.rolling_drift(batch, FEATURES, _days(batch), ON).select("run_date", "column", "psi", "severity")


def _days(batch):
    """All days of a table, from its first to its last. Collected: two dates."""
    first, last = batch.agg(F.min("run_date"), F.max("run_date")).first()
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


@query("psi_reference_window", f"""WITH {BATCH_SQL},
newest AS (SELECT max(run_date) AS last FROM batch), {_psi_sql(
    _long_sql("batch JOIN newest ON run_date BETWEEN last - INTERVAL 30 DAY AND last - INTERVAL 1 DAY", FEATURES),
    _long_sql("batch JOIN newest ON run_date = last", FEATURES))}{_GRADED}""")
def psi_reference_window(spark, sf_dir):
    """The newest date against the window before it."""
    batch = events_batch(spark, sf_dir)
    newest = batch.agg(F.max("run_date")).first()[0]
    reference = drift.reference_window(batch, newest, ON.reference_days)
    return drift.drift_check(batch.filter(F.col("run_date") == F.lit(newest)), reference, FEATURES, ON).select(
        "column", "psi", "severity"
    )


# Every day against the whole month, with tight bounds so that quiet days and drifted days both occur.
TIGHT = DriftSpec(enabled=True, psi_warn=0.04, psi_critical=0.06)
_DAILY = f"""{BATCH_SQL}, {_psi_sql(
    _long_sql("batch", FEATURES), _long_sql("batch", FEATURES, "run_date,"), "run_date,")},
daily AS (
  SELECT run_date, "column", round(psi, 4) AS psi, psi AS exact,
         CASE WHEN psi >= 0.06 THEN 'critical' WHEN psi >= 0.04 THEN 'warn' ELSE 'none' END AS severity FROM psi)"""


def _daily(spark, sf_dir):
    batch = events_batch(spark, sf_dir)
    rows = drift.drift_check(batch, batch.drop("run_date"), FEATURES, TIGHT, ["run_date"])
    return rows.withColumn("project_id", F.lit(EVENTS.project_id))


@query("drift_by_date", f"""WITH {_DAILY}
SELECT run_date, "column", psi, severity FROM daily""")
def drift_by_date(spark, sf_dir):
    return _daily(spark, sf_dir).select("run_date", "column", "psi", "severity")


@query("drift_sustained_3_of_5", f"""WITH {_DAILY}
SELECT run_date, "column", severity, drifted_days, drifted_days >= 3 AS sustained
FROM (SELECT *, sum(CASE WHEN severity <> 'none' THEN 1 ELSE 0 END)
        OVER (PARTITION BY "column" ORDER BY run_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS drifted_days
      FROM daily)""")
def drift_sustained_3_of_5(spark, sf_dir):
    return drift.sustained_drift(_daily(spark, sf_dir)).select(
        "run_date", "column", "severity", "drifted_days", "sustained"
    )


@query("drift_critical_union", f"""WITH {_MONITOR}, {_DAILY.split(BATCH_SQL + ",", 1)[1]}
SELECT run_date, 'check' AS source, check_name AS name, message FROM report WHERE NOT passed
UNION ALL
SELECT run_date, 'drift', "column", printf('PSI=%.4f (critical)', round(exact, 4)) FROM daily WHERE severity = 'critical'""")
def drift_critical_union(spark, sf_dir):
    rows = alerts.immediate_alerts(_monitor(spark, sf_dir), _daily(spark, sf_dir))
    return rows.select("run_date", "source", "name", "message")
