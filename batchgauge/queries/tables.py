"""Sinks, jobs and joins: write, read back, and look up."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import functions as F

from batchgauge.config import CheckSpec, EvalSpec, OutputSpec, SourceSpec
from batchgauge.operators import lookups, monitor, sampling, sinks
from batchgauge.plans import jobs
from batchgauge.queries.checks import _MONITOR, _monitor
from batchgauge.queries.inputs import (
    BATCH_SQL, EVENT_SCORER, EVENTS, RUN_LOG_SQL, SCORED_SQL, events_batch, events_run_log, events_scored,
)
from batchgauge.queries.registry import query, rounded, table
from batchgauge.session import scratch_folder

# No limits: every day passes the gates.
LENIENT = replace(EVENTS, monitoring=CheckSpec(null_output_max_pct=100.0))


def _days(scored):
    """All days of a table, from its first to its last. Collected: two dates."""
    first, last = scored.agg(F.min("run_date"), F.max("run_date")).first()
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def _store(spark, label):
    return sinks.Store(spark, scratch_folder(spark, label))


def _stored(store, project, scored):
    columns = ["event_id", "run_date", "risk", "load"]
    return store.result(project, scored.schema).select(*columns).withColumns(rounded("risk", "load"))


@query("sink_append_skip", f"""WITH {SCORED_SQL}
SELECT event_id, run_date, round(risk, 6) AS risk, round(load, 6) AS load FROM scored""")
def sink_append_skip(spark, sf_dir):
    """The second append finds every date written and changes nothing."""
    store, scored = _store(spark, "append"), events_scored(spark, sf_dir)
    sinks.save_dates(store, scored, EVENTS, _days(scored))
    sinks.save_dates(store, scored.withColumn("risk", F.lit(0.5)), EVENTS, _days(scored))
    return _stored(store, EVENTS, scored)


@query("sink_replace_date", f"""WITH {SCORED_SQL}
SELECT event_id, run_date, CASE WHEN run_date >= DATE '2024-01-16' THEN 0.5 ELSE round(risk, 6) END AS risk, round(load, 6) AS load
FROM scored""")
def sink_replace_date(spark, sf_dir):
    """Replacing the later half of the month leaves the other dates as they are."""
    store, scored = _store(spark, "replace"), events_scored(spark, sf_dir)
    sinks.save_dates(store, scored, EVENTS, _days(scored))
    project = EVENTS.with_write_mode("replace_date")
    sinks.save_dates(store, scored.withColumn("risk", F.lit(0.5)), project, [d for d in _days(scored) if d >= date(2024, 1, 16)])
    return _stored(store, project, scored)


@query("sink_read_date", f"""WITH {SCORED_SQL}
SELECT event_id, run_date, round(risk, 6) AS risk FROM scored WHERE run_date = DATE '2024-01-10' ORDER BY event_id LIMIT 5""")
def sink_read_date(spark, sf_dir):
    """A top-5 report of one stored date; reads one partition."""
    from batchgauge.operators.views import predictions_of

    store, scored = _store(spark, "date"), events_scored(spark, sf_dir)
    sinks.save_dates(store, scored, EVENTS, _days(scored))
    return predictions_of(_stored(store, EVENTS, scored), "2024-01-10", ["event_id"]).select("event_id", "run_date", "risk")


@query("sink_key_dedup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def sink_key_dedup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return sinks.dedup_keys(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("sink_unseen_keys", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""")
def sink_unseen_keys(spark, sf_dir):
    stored = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return sinks.unseen_keys(lines, stored, ["l_orderkey"])


@query("run_log_rows", f"""WITH {BATCH_SQL}, {RUN_LOG_SQL}
SELECT project_id, run_date, status, row_count FROM run_log""")
def run_log_rows(spark, sf_dir):
    store = _store(spark, "runs")
    store.ensure_platform_tables()
    rows = events_run_log(spark, sf_dir).withColumns({
        "duration_sec": F.lit(None).cast("double"), "error_message": F.lit(None).cast("string"),
    })
    store.append_log("run_log", rows)
    return store.read("run_log").select("project_id", "run_date", "status", "row_count")


@query("monitoring_log_rows", f"""WITH {_MONITOR}
SELECT 'events_score' AS project_id, run_date, check_name, passed, value, threshold FROM report""")
def monitoring_log_rows(spark, sf_dir):
    store = _store(spark, "checks")
    store.ensure_platform_tables()
    sinks.log_checks(store, _monitor(spark, sf_dir))
    return store.read("monitoring_log").drop("created_at")


# About 1 % of either score is missing, so some days are above this limit at any table size.
STRICT = replace(EVENTS, monitoring=CheckSpec(null_output_max_pct=1.1, prediction_range={"load": (0.0, 10.0)}))
_STRICT_DAYS = SCORED_SQL + """,
days AS (
  SELECT run_date, count(*) AS n, count(*) FILTER (risk IS NULL) * 100.0 / count(*) AS risk_pct,
         count(*) FILTER (load IS NULL) * 100.0 / count(*) AS load_pct, count(*) FILTER (load > 10 OR load < 0) AS n_out
  FROM scored GROUP BY run_date),
verdict AS (
  SELECT run_date, n, CASE
    WHEN risk_pct > 1.1 THEN printf('Column ''risk'' has %.1f%% NaN values (threshold: 1.1%%)', round(risk_pct, 1))
    WHEN load_pct > 1.1 THEN printf('Column ''load'' has %.1f%% NaN values (threshold: 1.1%%)', round(load_pct, 1))
    WHEN n_out > 0 THEN printf('Column ''load'' has %d values outside range [0.0, 10.0]', n_out) END AS error_message
  FROM days)"""


@query("backfill_range", f"""WITH {_STRICT_DAYS}
SELECT event_id, run_date, round(risk, 6) AS risk, round(load, 6) AS load
FROM scored JOIN verdict USING (run_date) WHERE error_message IS NULL""")
def backfill_range(spark, sf_dir):
    """All days in one job; the days that fail a gate are not written."""
    store = _store(spark, "backfill")
    batch = events_batch(spark, sf_dir)
    jobs.backfill(spark, store, STRICT, EVENT_SCORER, _days(batch)[0], _days(batch)[-1], batch)
    return _stored(store, STRICT, events_scored(spark, sf_dir))


@query("backfill_outcomes", f"""WITH {_STRICT_DAYS}
SELECT run_date, CASE WHEN error_message IS NULL THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN error_message IS NULL THEN n ELSE 0 END AS row_count, error_message FROM verdict
UNION ALL SELECT DATE '2023-12-31', 'failed', 0, 'Input DataFrame is empty — no rows returned from data source'""")
def backfill_outcomes(spark, sf_dir):
    store = _store(spark, "outcomes")
    batch = events_batch(spark, sf_dir)
    return jobs.backfill(spark, store, STRICT, EVENT_SCORER, "2023-12-31", _days(batch)[-1], batch)


KEYED = replace(
    LENIENT, output=OutputSpec("results.keyed", "append", ("user_id",)),
    schema=replace(EVENTS.schema, id_columns=("event_id", "user_id")),
)


@query("backfill_key_dedup", """
SELECT max(event_id) AS event_id, user_id, CAST(ts AS DATE) AS run_date FROM events GROUP BY ALL""")
def backfill_key_dedup(spark, sf_dir):
    """One row per user and day, the one with the greatest event id, from one job over all days."""
    store, batch = _store(spark, "keyed"), events_batch(spark, sf_dir)
    days = _days(batch)
    jobs.backfill(spark, store, KEYED, EVENT_SCORER, days[0], days[-1], batch)
    return store.read("results.keyed").select("event_id", "user_id", "run_date")


@query("daily_run", f"""WITH {SCORED_SQL}
SELECT event_id, run_date, round(risk, 6) AS risk, round(load, 6) AS load FROM scored WHERE run_date = DATE '2024-01-12'""")
def daily_run(spark, sf_dir):
    """One date from source to table, with health checks afterwards."""
    store, day = _store(spark, "daily"), "2024-01-12"
    batch = events_batch(spark, sf_dir).filter(F.col("run_date") == F.lit(day).cast("date"))
    jobs.daily_run(spark, store, LENIENT, EVENT_SCORER, day, batch, with_monitoring=True)
    return _stored(store, LENIENT, events_scored(spark, sf_dir))


@query("run_active_projects", f"""WITH {SCORED_SQL},
day AS (SELECT count(*) AS n, count(*) FILTER (load > 0.1) AS high FROM scored WHERE run_date = DATE '2024-01-12')
SELECT 'events_lenient' AS project_id, DATE '2024-01-12' AS run_date, 'success' AS status, n AS row_count,
       CAST(NULL AS VARCHAR) AS error_message FROM day
UNION ALL
SELECT 'events_narrow', DATE '2024-01-12', 'failed', 0,
       printf('Column ''load'' has %d values outside range [0.0, 0.1]', high) FROM day""")
def run_active_projects(spark, sf_dir):
    """Each active project reads its own SQL batch; one failing project does not stop the other."""
    events_batch(spark, sf_dir).createOrReplaceTempView("batchgauge_batch")
    source = SourceSpec("sql", query="SELECT * FROM batchgauge_batch WHERE run_date = '{run_date}'")
    limits = CheckSpec(null_output_max_pct=100.0, prediction_range={"load": (0.0, 0.1)})
    projects = {
        "events_lenient": replace(LENIENT, project_id="events_lenient", input=source),
        "events_narrow": replace(
            LENIENT, project_id="events_narrow", input=source, monitoring=limits, output=OutputSpec("results.narrow")
        ),
    }
    registry = spark.createDataFrame(
        [(p, "active") for p in projects] + [("_example", "active"), ("events_old", "paused")],
        "project_id string, status string",
    )
    store = _store(spark, "active")
    jobs.run_active(spark, store, projects, registry, dict.fromkeys(projects, EVENT_SCORER), "2024-01-12")
    return store.read("run_log").drop("duration_sec", "created_at")


@query("preflight_problems", f"""WITH {SCORED_SQL},
high AS (SELECT count(*) FILTER (load > 1) AS n FROM scored)
SELECT 'range' AS project, printf('a trial scoring did not pass: Column ''load'' has %d values outside range [0.0, 1.0]', n) AS problem
FROM high WHERE n > 0
UNION ALL SELECT 'columns', 'the input lacks [''no_such_feature'']'
UNION ALL SELECT 'metrics', '''r2'' has a limit but is not computed' """)
def preflight_problems(spark, sf_dir):
    """Pre-flight of four project settings over all events; the sound one has no problems."""
    batch = events_batch(spark, sf_dir)
    wide = replace(EVENTS.schema, feature_columns=(*EVENTS.schema.feature_columns, "no_such_feature"))
    projects = {
        "sound": LENIENT,
        "range": replace(LENIENT, monitoring=CheckSpec(null_output_max_pct=100.0, prediction_range={"load": (0.0, 1.0)})),
        "columns": replace(LENIENT, schema=wide),
        "metrics": replace(LENIENT, evaluation=EvalSpec(("mse",), {"r2": 0.5})),
    }
    found = [
        (name, problem) for name, project in projects.items()
        for problem in jobs.preflight(spark, project, EVENT_SCORER, "2024-01-30", batch)
    ]
    return spark.createDataFrame(found, "project string, problem string")


@query("dry_run_stats", f"""WITH {SCORED_SQL},
cells AS (SELECT 'risk' AS "column", risk AS value FROM scored UNION ALL SELECT 'load', load FROM scored)
SELECT "column", round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean,
       count(*) FILTER (value IS NULL) AS null_count FROM cells GROUP BY "column" """)
def dry_run_stats(spark, sf_dir):
    _, _, stats = jobs.dry_run(spark, LENIENT, EVENT_SCORER, "2024-01-30", events_batch(spark, sf_dir))
    return stats.withColumns(rounded("min", "max", "mean"))


@query("ingest_csv", "SELECT * FROM lineitem")
def ingest_csv(spark, sf_dir):
    """Every column of a table, by way of a CSV file."""
    path, lines = scratch_folder(spark, "export") + ".csv", table(spark, sf_dir, "lineitem")
    lines.write.csv(path, header=True)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema)
    return sinks.ingest_csv(_store(spark, "ingest"), path, "features.lines", schema=schema)


@query("ingest_csv_texts", """
SELECT doc_id, nullif(text, '') AS text, lang, source, 'says "' || coalesce(source, '') || '", then
goes on; ' || doc_id AS note FROM documents""")
def ingest_csv_texts(spark, sf_dir):
    """Texts with quotes, separators and line breaks inside their cells."""
    path = scratch_folder(spark, "texts") + ".csv"
    note = F.concat(F.lit('says "'), F.coalesce("source", F.lit("")), F.lit('", then\ngoes on; '), F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", note.alias("note"))
    docs.write.csv(path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    schema = "doc_id long, text string, lang string, source string, note string"
    return sinks.ingest_csv(_store(spark, "ingest-texts"), path, "features.texts", schema=schema)


@query("ingest_sample", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || '|42'), o_orderkey LIMIT 5000""")
def ingest_sample(spark, sf_dir):
    """The sampling operator: exactly 5,000 rows of any table size."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.sample_rows(orders, 5000, ["o_orderkey"])


@query("label_join_lag", f"""WITH {SCORED_SQL},
truth AS (
  SELECT event_id, is_error AS confirmed, run_date + CAST(CASE WHEN value > 50 THEN 14 ELSE 13 END AS INT) AS label_date
  FROM batch)
SELECT s.event_id, s.run_date, round(risk, 6) AS risk, confirmed
FROM scored s JOIN truth t ON s.event_id = t.event_id AND t.label_date = s.run_date + 14""")
def label_join_lag(spark, sf_dir):
    """Labels arrive 13 or 14 days after scoring; a lag of 14 days is asked for."""
    lag = F.when(F.col("value") > 50, 14).otherwise(13)
    truth = events_batch(spark, sf_dir).select(
        "event_id", F.col("is_error").alias("confirmed"), F.date_add("run_date", lag).alias("label_date")
    )
    joined = lookups.join_labels(events_scored(spark, sf_dir), truth, ["event_id"], "confirmed", 14)
    return joined.select("event_id", "run_date", "risk", "confirmed").withColumns(rounded("risk"))


@query("asof_previous_run", f"""WITH {BATCH_SQL}, {RUN_LOG_SQL},
days AS (SELECT 'events_score' AS project_id, run_date, count(*) AS n_rows FROM batch GROUP BY run_date)
SELECT d.project_id, d.run_date, d.n_rows, l.row_count AS previous_count
FROM days d ASOF LEFT JOIN last_success l ON d.project_id = l.project_id AND d.run_date > l.run_date""")
def asof_previous_run(spark, sf_dir):
    days = events_batch(spark, sf_dir).groupBy("run_date").agg(F.count("*").alias("n_rows")).select(
        F.lit(EVENTS.project_id).alias("project_id"), "run_date", "n_rows"
    )
    return monitor.previous_count(days, events_run_log(spark, sf_dir))


@query("model_alias_resolve", """
WITH versions AS (
  SELECT p_brand AS name, p_partkey AS version,
         CASE WHEN p_partkey = max(p_partkey) OVER b THEN 'Candidate'
              WHEN p_partkey = min(p_partkey) OVER b THEN 'Production' END AS alias
  FROM part WINDOW b AS (PARTITION BY p_brand)),
requests AS (
  SELECT l_orderkey, l_linenumber, p_brand AS name,
         CASE l_returnflag WHEN 'R' THEN 'Production' WHEN 'A' THEN 'Candidate' ELSE CAST(l_suppkey AS VARCHAR) END AS version
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT r.l_orderkey, r.l_linenumber, r.name, r.version, coalesce(a.version, n.version) AS resolved_version
FROM requests r
LEFT JOIN versions a ON a.name = r.name AND a.alias = r.version
LEFT JOIN versions n ON n.name = r.name AND CAST(n.version AS VARCHAR) = r.version""")
def model_alias_resolve(spark, sf_dir):
    """Brands as models, part keys as versions; digits mean a version, words an alias."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    ends = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("lo"), F.max("p_partkey").alias("hi"))
    alias = F.when(F.col("p_partkey") == F.col("hi"), F.array(F.lit("Candidate"))).when(
        F.col("p_partkey") == F.col("lo"), F.array(F.lit("Production"))
    ).otherwise(F.array().cast("array<string>"))
    versions = parts.join(ends, "p_brand").select(
        F.col("p_brand").alias("name"), F.col("p_partkey").alias("version"), alias.alias("aliases")
    )
    asked = F.when(F.col("l_returnflag") == "R", "Production").when(F.col("l_returnflag") == "A", "Candidate").otherwise(
        F.col("l_suppkey").cast("string")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", asked.alias("version"))
    requests = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", F.col("p_brand").alias("name"), "version"
    )
    return lookups.resolve_models(requests, versions)


@query("active_projects", """
SELECT project_id, status FROM (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN '_' ELSE '' END || lower(c_name) AS project_id,
         CASE WHEN c_acctbal > 0 THEN 'active' ELSE 'paused' END AS status FROM customer)
WHERE NOT starts_with(project_id, '_') AND status = 'active'""")
def active_projects(spark, sf_dir):
    """Customers as projects."""
    registry = table(spark, sf_dir, "customer").select(
        F.concat(F.when(F.col("c_mktsegment") == "MACHINERY", "_").otherwise(""), F.lower("c_name")).alias("project_id"),
        F.when(F.col("c_acctbal") > 0, "active").otherwise("paused").alias("status"),
    )
    return lookups.active_projects(registry)
