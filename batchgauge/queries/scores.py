"""Sources and scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from batchgauge.config import ColumnSpec, SourceSpec
from batchgauge.functions.columns import indicator, logistic
from batchgauge.operators import scoring
from batchgauge.queries.inputs import (
    BATCH_SQL, FEATURES, RISK_SQL, SCORED_SQL, events_batch, events_scored,
)
from batchgauge.queries.registry import query, rounded, table
from batchgauge.session import scratch_folder
from batchgauge.sources import readers

DAY = "2024-01-15"


@query("src_sql_run_date", f"""
SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = DATE '{DAY}'""")
def src_sql_run_date(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("batchgauge_events")
    text = "SELECT event_id, user_id, value FROM batchgauge_events WHERE CAST(ts AS DATE) = '{run_date}'"
    return readers.fetch(spark, SourceSpec(source="SQL", query=text), DAY)


@query("src_sql_date_in_literal", f"""
SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = DATE '{DAY}'""")
def src_sql_date_in_literal(spark, sf_dir):
    """The date alone and inside longer literals."""
    table(spark, sf_dir, "events").createOrReplaceTempView("batchgauge_events")
    text = (
        "SELECT event_id, user_id, value FROM batchgauge_events WHERE CAST(ts AS STRING) LIKE '{run_date}%' "
        "AND ts >= '{run_date} 00:00:00' AND CAST(ts AS DATE) = {run_date}"
    )
    return readers.fetch(spark, SourceSpec(source="SQL", query=text), DAY)


@query("src_parquet", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def src_parquet(spark, sf_dir):
    spec = SourceSpec(source="file", connection={"path": f"{sf_dir}/orders.parquet"})
    return readers.fetch(spark, spec, DAY).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query("src_csv_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def src_csv_roundtrip(spark, sf_dir):
    path = scratch_folder(spark, "orders") + ".csv"
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    rows.write.csv(path, header=True)
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"
    return readers.fetch(spark, SourceSpec("file", {"path": path, "schema": schema}), DAY)


@query("src_tsv_roundtrip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_tsv_roundtrip(spark, sf_dir):
    path = scratch_folder(spark, "customer") + ".tsv"
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.csv(path, sep="\t", header=True)
    schema = "c_custkey long, c_name string, c_acctbal double"
    return readers.fetch(spark, SourceSpec("file", {"path": path, "schema": schema}), DAY)


@query("src_csv_quoted_cells", """
SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' || chr(10) || 'line two' AS c_name, c_acctbal FROM customer""")
def src_csv_quoted_cells(spark, sf_dir):
    """Cells that hold separators, quotes and line breaks."""
    path = scratch_folder(spark, "cells") + ".csv"
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nline two'))
    rows = table(spark, sf_dir, "customer").select("c_custkey", name.alias("c_name"), "c_acctbal")
    rows.write.csv(path, header=True, quote='"', escape='"')
    schema = "c_custkey long, c_name string, c_acctbal double"
    return readers.fetch(spark, SourceSpec("file", {"path": path, "schema": schema}), DAY)


@query("src_path_template", BATCH_SQL.join(["WITH", f"""
SELECT event_id, value, hour FROM batch WHERE run_date = DATE '{DAY}'"""]))
def src_path_template(spark, sf_dir):
    root = scratch_folder(spark, "dated")
    batch = events_batch(spark, sf_dir).select("event_id", "value", "hour", "run_date")
    batch.filter(F.col("run_date") == F.lit(DAY).cast("date")).drop("run_date").write.parquet(f"{root}/batch_{DAY}.parquet")
    return readers.fetch(spark, SourceSpec("file", {"path": root + "/batch_{run_date}.parquet"}), DAY)


@query("score_expr", f"""WITH {SCORED_SQL}
SELECT event_id, run_date, round(risk, 6) AS risk, round(load, 6) AS load FROM scored""")
def score_expr(spark, sf_dir):
    return events_scored(spark, sf_dir).withColumns(rounded("risk", "load"))


def _weights():
    return {"value": 0.02, "k": 0.01, "hour": -0.05, "is_error": 0.8}


def _risk(model, x):
    z = sum(w * x[name] for name, w in model.items()) - 1.5
    return 1.0 / (1.0 + np.exp(-z))


@query("score_map_in_pandas", f"""WITH {BATCH_SQL}
SELECT event_id, run_date, round({RISK_SQL}, 6) AS risk FROM batch""")
def score_map_in_pandas(spark, sf_dir):
    columns = ColumnSpec(("event_id",), tuple(FEATURES), ("risk",))
    scorer = scoring.batch_scorer(_weights, _risk, columns, carry=["run_date"])
    scored = scoring.scored_batch(events_batch(spark, sf_dir), scorer, columns, F.col("run_date"))
    return scored.withColumns(rounded("risk"))


def _two_outputs(model, x):
    p = _risk(model, x)
    return np.column_stack([p, 1.0 - p])


@query("score_multi_output", f"""WITH {BATCH_SQL}
SELECT event_id, run_date, round({RISK_SQL}, 6) AS p_bad, round(1 - {RISK_SQL}, 6) AS p_good FROM batch""")
def score_multi_output(spark, sf_dir):
    columns = ColumnSpec(("event_id",), tuple(FEATURES), ("p_bad", "p_good"))
    scorer = scoring.batch_scorer(_weights, _two_outputs, columns, carry=["run_date"])
    scored = scoring.scored_batch(events_batch(spark, sf_dir), scorer, columns, F.col("run_date"))
    return scored.withColumns(rounded("p_bad", "p_good"))


@query("score_mllib")
def score_mllib(spark, sf_dir):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    batch = events_batch(spark, sf_dir)
    features = ["value", "hour", "k"]
    train = VectorAssembler(inputCols=features, outputCol="_features").transform(batch)
    model = LogisticRegression(featuresCol="_features", labelCol="is_error", regParam=0.01).fit(train)
    columns = ColumnSpec(("event_id",), tuple(features), ("p_error",))
    scorer = scoring.fitted_scorer(model, "p_error", features)
    return scoring.scored_batch(batch, scorer, columns, F.col("run_date")).withColumns(rounded("p_error", digits=4))


@query("assemble_output", """
SELECT o_orderkey, o_custkey, round(1 / (1 + exp(-(o_totalprice / 100000 - 2))), 6) AS size_score,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent, CAST(o_orderdate AS DATE) AS run_date
FROM orders""")
def assemble_output(spark, sf_dir):
    columns = ColumnSpec(("o_orderkey", "o_custkey"), ("o_totalprice", "o_orderpriority"), ("size_score", "urgent"))
    scorer = scoring.expression_scorer({
        "size_score": logistic(F.col("o_totalprice") / 100000 - 2),
        "urgent": indicator(F.col("o_orderpriority"), "1-URGENT"),
    })
    scored = scoring.scored_batch(table(spark, sf_dir, "orders"), scorer, columns, F.col("o_orderdate"))
    return scored.withColumns(rounded("size_score"))
