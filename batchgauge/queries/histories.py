"""History and distribution views."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgauge.operators import gates, views
from batchgauge.queries.inputs import (
    SCORED_SQL, TYPED_CHECKS_SQL, TYPED_LOG_SQL, events_scored, typed_monitoring_log, typed_run_log,
)
from batchgauge.queries.registry import query, rounded, table


@query("view_projects", """
SELECT lower(s_name) AS project_id, 'nation ' || s_nationkey AS owner, CASE WHEN s_acctbal > 0 THEN 'active' ELSE 'paused' END AS status
FROM supplier""")
def view_projects(spark, sf_dir):
    """Suppliers as projects."""
    return views.project_list(table(spark, sf_dir, "supplier").select(
        F.lower("s_name").alias("project_id"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("owner"),
        F.when(F.col("s_acctbal") > 0, "active").otherwise("paused").alias("status"),
    ))


@query("view_run_history", f"""WITH {TYPED_LOG_SQL}
SELECT run_date, status, row_count, duration_sec, created_at FROM run_log WHERE project_id = 'score_click'
ORDER BY run_date DESC, created_at DESC LIMIT 30""")
def view_run_history(spark, sf_dir):
    return views.run_history(typed_run_log(spark, sf_dir), "score_click").drop("project_id")


@query("view_check_history", f"""WITH {TYPED_CHECKS_SQL}
SELECT run_date, check_name, passed, value, threshold FROM monitoring_log WHERE project_id = 'score_view'
ORDER BY run_date DESC, check_name, created_at DESC LIMIT 100""")
def view_check_history(spark, sf_dir):
    return views.check_history(typed_monitoring_log(spark, sf_dir), "score_view").select(
        "run_date", "check_name", "passed", "value", "threshold"
    )


@query("view_recent_predictions", f"""WITH {SCORED_SQL}
SELECT event_id, run_date, round(risk, 6) AS risk, round(load, 6) AS load FROM scored ORDER BY run_date DESC, event_id LIMIT 100""")
def view_recent_predictions(spark, sf_dir):
    return views.recent_predictions(events_scored(spark, sf_dir), ["event_id"]).withColumns(rounded("risk", "load"))


@query("view_latest_run", f"""WITH {TYPED_LOG_SQL}
SELECT project_id, run_date, status, row_count, duration_sec, created_at FROM run_log
QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY run_date DESC, created_at DESC) = 1""")
def view_latest_run(spark, sf_dir):
    return views.latest_run(typed_run_log(spark, sf_dir))


@query("view_latest_created", f"""WITH {TYPED_LOG_SQL}
SELECT project_id, run_date, status, row_count, created_at FROM run_log
QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY created_at DESC) = 1""")
def view_latest_created(spark, sf_dir):
    return views.latest_run(typed_run_log(spark, sf_dir), by_creation=True).drop("duration_sec")


@query("view_latest_checks", f"""WITH {TYPED_CHECKS_SQL}
SELECT project_id, run_date, check_name, passed, value FROM monitoring_log
QUALIFY rank() OVER (PARTITION BY project_id ORDER BY run_date DESC) = 1""")
def view_latest_checks(spark, sf_dir):
    return views.latest_checks(typed_monitoring_log(spark, sf_dir)).select(
        "project_id", "run_date", "check_name", "passed", "value"
    )


@query("view_check_trend", f"""WITH {TYPED_CHECKS_SQL}
SELECT run_date, value, threshold, passed FROM monitoring_log
WHERE project_id = 'score_error' AND check_name = 'row_count_change'""")
def view_check_trend(spark, sf_dir):
    return views.check_trend(typed_monitoring_log(spark, sf_dir), "score_error", "row_count_change")


@query("view_distinct_checks", f"WITH {TYPED_CHECKS_SQL} SELECT DISTINCT check_name FROM monitoring_log")
def view_distinct_checks(spark, sf_dir):
    return views.check_names(typed_monitoring_log(spark, sf_dir))


@query("view_histogram", f"""WITH {SCORED_SQL},
cells AS (SELECT 'risk' AS "column", risk AS value FROM scored WHERE risk IS NOT NULL
          UNION ALL SELECT 'load', load FROM scored WHERE load IS NOT NULL),
bounds AS (SELECT "column", min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM cells GROUP BY "column"),
counts AS (
  SELECT "column", CAST(least(greatest(ceil((value - lo) / w), 1), 30) AS INT) AS bin, count(*) AS n
  FROM cells JOIN bounds USING ("column") GROUP BY ALL)
SELECT "column", bin, round(lo + (bin - 1) * w, 6) AS low, round(lo + bin * w, 6) AS high, coalesce(n, 0) AS n
FROM (SELECT *, CAST(unnest(range(1, 31)) AS INT) AS bin FROM bounds) LEFT JOIN counts USING ("column", bin)""")
def view_histogram(spark, sf_dir):
    return views.histogram(events_scored(spark, sf_dir), ["risk", "load"]).withColumns(rounded("low", "high"))


@query("view_output_stats", f"""WITH {SCORED_SQL},
cells AS (SELECT run_date, 'risk' AS "column", risk AS value FROM scored UNION ALL SELECT run_date, 'load', load FROM scored)
SELECT run_date, "column", round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean,
       count(*) FILTER (value IS NULL) AS null_count FROM cells GROUP BY ALL""")
def view_output_stats(spark, sf_dir):
    stats = gates.output_stats(events_scored(spark, sf_dir), ["risk", "load"], ["run_date"])
    return stats.withColumns(rounded("min", "max", "mean"))


@query("view_topk", """
SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT 5""")
def view_topk(spark, sf_dir):
    """A top-5 report."""
    revenue = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("revenue")
    )
    return views.top_rows(revenue, "revenue", 5, "l_partkey")


@query("view_first_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount LIMIT 50000""")
def view_first_rows(spark, sf_dir):
    """The LIMIT operator over an input query, made repeatable by a full order."""
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]
    return views.first_rows(table(spark, sf_dir, "lineitem").select(*names), 50_000, names)


@query("view_first_rows_text", """
SELECT l_returnflag, l_linestatus, l_shipdate, l_orderkey, l_linenumber FROM lineitem
ORDER BY l_returnflag, l_linestatus, l_shipdate, l_orderkey, l_linenumber, l_partkey LIMIT 20000""")
def view_first_rows_text(spark, sf_dir):
    """A text key first, with very many ties, then a time: the same LIMIT operator."""
    names = ["l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber"]
    rows = table(spark, sf_dir, "lineitem").select(*names, "l_partkey")
    return views.first_rows(rows, 20_000, [*names, "l_partkey"]).drop("l_partkey")
