"""Evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgauge.config import add_metric, add_ranked_metric
from batchgauge.functions.columns import logistic
from batchgauge.operators import metrics
from batchgauge.queries.inputs import BATCH_SQL, events_batch
from batchgauge.queries.registry import query, rounded, table


def sales(spark, sf_dir):
    """Line items with a two-class truth, a score and a prediction."""
    score = logistic(F.col("l_extendedprice") / 20000 - 1.8)
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") >= 25).cast("int").alias("y"), score.alias("p"),
        (score >= 0.5).cast("int").alias("predicted"), F.trunc("l_shipdate", "year").alias("run_date"),
    )


_SALES = """
sales AS (
  SELECT CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS y, p, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS predicted, run_date
  FROM (SELECT *, 1 / (1 + exp(-(l_extendedprice / 20000 - 1.8))) AS p, CAST(date_trunc('year', l_shipdate) AS DATE) AS run_date
        FROM lineitem))"""


def _rank_sql(source: str, y: str, score: str, by: str = "") -> str:
    """CTE ``ranked`` (by…, auc, ks): ties share a row, prefix sums over the distinct scores."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
tied AS (
  SELECT {keys}{score} AS s, count(*) FILTER ({y} = 1) AS pos, count(*) FILTER ({y} = 0) AS neg
  FROM {source} GROUP BY ALL),
prefix AS (
  SELECT *, sum(pos) OVER ({part} ORDER BY s) AS cp, sum(neg) OVER ({part} ORDER BY s) AS cn,
         sum(pos) OVER ({part}) AS np, sum(neg) OVER ({part}) AS nn
  FROM tied),
ranked AS (
  SELECT {keys}sum(pos * (cn - neg + neg / 2)) / (max(np)::DOUBLE * max(nn)) AS auc,
         max(abs(cp / np - cn / nn)) AS ks
  FROM prefix GROUP BY ALL)"""


@query("m_auc", f"WITH {_SALES}, {_rank_sql('sales', 'y', 'p')} SELECT round(auc, 6) AS auc_roc FROM ranked")
def m_auc(spark, sf_dir):
    return metrics.ranked_metrics(sales(spark, sf_dir), "y", "p").select(F.round("auc_roc", 6).alias("auc_roc"))


@query("m_ks", f"WITH {_SALES}, {_rank_sql('sales', 'y', 'p')} SELECT round(ks, 6) AS ks_statistic FROM ranked")
def m_ks(spark, sf_dir):
    return metrics.ranked_metrics(sales(spark, sf_dir), "y", "p").select(F.round("ks_statistic", 6).alias("ks_statistic"))


@query("m_gini", f"WITH {_SALES}, {_rank_sql('sales', 'y', 'p')} SELECT round(2 * auc - 1, 6) AS gini FROM ranked")
def m_gini(spark, sf_dir):
    return metrics.ranked_metrics(sales(spark, sf_dir), "y", "p").select(F.round("gini", 6).alias("gini"))


@query("m_log_loss", f"""WITH {_SALES}
SELECT round(avg(-ln(least(greatest(CASE WHEN y = 1 THEN p ELSE 1 - p END, 2.220446049250313e-16), 1 - 2.220446049250313e-16))), 6) AS log_loss
FROM sales""")
def m_log_loss(spark, sf_dir):
    return metrics.pointwise_metrics(sales(spark, sf_dir), "y", None, "p", ["log_loss"]).withColumns(rounded("log_loss"))


def statuses(spark, sf_dir):
    """Orders with their status, three class scores that add up to one, and the best class."""
    a, b, c = 1 + F.col("o_totalprice") / 100000, 1 + F.col("o_custkey") / 400, F.lit(2.5)
    total = a + b + c
    best = F.when((a >= b) & (a >= c), "F").when(b >= c, "O").otherwise("P")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("y"), best.alias("predicted"),
        (a / total).alias("p_f"), (b / total).alias("p_o"), (c / total).alias("p_p"),
    )


CLASS_SCORES = {"F": "p_f", "O": "p_o", "P": "p_p"}
_STATUSES = """
statuses AS (
  SELECT o_orderstatus AS y, CASE WHEN a >= b AND a >= c THEN 'F' WHEN b >= c THEN 'O' ELSE 'P' END AS predicted,
         a / (a + b + c) AS p_f, b / (a + b + c) AS p_o, c / (a + b + c) AS p_p
  FROM (SELECT *, 1 + o_totalprice / 100000 AS a, 1 + o_custkey / 400 AS b, 2.5::DOUBLE AS c FROM orders))"""
_OVR = """
classes AS (
  SELECT 'F' AS class, CASE WHEN y = 'F' THEN 1 ELSE 0 END AS is_class, p_f AS score FROM statuses
  UNION ALL SELECT 'O', CASE WHEN y = 'O' THEN 1 ELSE 0 END, p_o FROM statuses
  UNION ALL SELECT 'P', CASE WHEN y = 'P' THEN 1 ELSE 0 END, p_p FROM statuses)"""
_LABELS = """
confusion AS (SELECT y, predicted, count(*) AS n FROM statuses GROUP BY ALL),
labels_seen AS (SELECT y AS label FROM confusion UNION SELECT predicted FROM confusion),
per_label AS (
  SELECT label, coalesce(sum(n) FILTER (y = label AND predicted = label), 0) AS tp,
         coalesce(sum(n) FILTER (y = label), 0) AS support, coalesce(sum(n) FILTER (predicted = label), 0) AS predicted
  FROM labels_seen, confusion GROUP BY label),
per_class AS (
  SELECT label, support, coalesce(tp / nullif(predicted, 0), 0) AS prec, coalesce(tp / nullif(support, 0), 0) AS rec,
         coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1 FROM per_label)"""


@query("m_auc_ovr", f"""WITH {_STATUSES}, {_OVR}, {_rank_sql('classes', 'is_class', 'score', 'class')}
SELECT round(avg(auc), 6) AS auc_roc FROM ranked""")
def m_auc_ovr(spark, sf_dir):
    return metrics.one_vs_rest_auc(statuses(spark, sf_dir), "y", CLASS_SCORES).withColumns(rounded("auc_roc"))


def _table_metric(name: str, expression: str):
    @query(f"m_{name}", f"WITH {_STATUSES}, {_LABELS} SELECT round({expression}, 6) AS {name} FROM per_class")
    def run(spark, sf_dir):
        rows = metrics.confusion_metrics(statuses(spark, sf_dir), "y", "predicted")
        return rows.select(F.round(name, 6).alias(name))


_table_metric("f1_macro", "avg(f1)")
_table_metric("f1_weighted", "sum(f1 * support) / sum(support)")
_table_metric("precision_macro", "avg(prec)")
_table_metric("recall_macro", "avg(rec)")


@query("m_label_scores", f"""WITH {_STATUSES}, {_LABELS}
SELECT label, support, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1 FROM per_class""")
def m_label_scores(spark, sf_dir):
    rows = metrics.label_scores(metrics.confusion_counts(statuses(spark, sf_dir), "y", "predicted"))
    return rows.drop("bad").withColumns(rounded("precision", "recall", "f1"))


@query("m_accuracy", f"WITH {_STATUSES} SELECT round(avg(CAST(y = predicted AS INT)), 6) AS accuracy FROM statuses")
def m_accuracy(spark, sf_dir):
    rows = metrics.pointwise_metrics(statuses(spark, sf_dir), "y", "predicted", None, ["accuracy"])
    return rows.withColumns(rounded("accuracy"))


@query("m_log_loss_multiclass", f"""WITH {_STATUSES}
SELECT round(avg(-ln(CASE y WHEN 'F' THEN p_f WHEN 'O' THEN p_o ELSE p_p END)), 6) AS log_loss FROM statuses""")
def m_log_loss_multiclass(spark, sf_dir):
    rows = metrics.pointwise_metrics(statuses(spark, sf_dir), "y", None, CLASS_SCORES, ["log_loss"])
    return rows.withColumns(rounded("log_loss"))


def prices(spark, sf_dir):
    """Line item prices, and the price a part list predicts."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    return lines.join(parts, "l_partkey").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("predicted")
    )


_PRICES = """
prices AS (
  SELECT l_extendedprice AS y, l_quantity * p_retailprice AS predicted
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _regression(name: str, expression: str, digits: int):
    @query(f"m_{name}", f"WITH {_PRICES} SELECT round({expression}, {digits}) AS {name} FROM prices")
    def run(spark, sf_dir):
        rows = metrics.pointwise_metrics(prices(spark, sf_dir), "y", "predicted", None, [name])
        return rows.select(F.round(name, digits).alias(name))


# Squared prices reach 10 digits before the point: fewer decimals are meaningful there.
_regression("mse", "avg((y - predicted) * (y - predicted))", 2)
_regression("rmse", "sqrt(avg((y - predicted) * (y - predicted)))", 6)
_regression("mae", "avg(abs(y - predicted))", 6)
_regression("r2", "1 - avg((y - predicted) * (y - predicted)) / var_pop(y)", 6)


SALES_METRICS = ["auc_roc", "f1_macro", "accuracy", "log_loss", "ks_statistic", "gini", "mae"]
SALES_LIMITS = {"auc_roc": 0.8, "f1_macro": 0.99, "log_loss": 0.7, "mae": 0.01, "rmse": 0.5}
_SALES_RESULTS = f"""{_SALES}, {_rank_sql('sales', 'y', 'p')},
confusion AS (
  SELECT count(*) FILTER (y = 1 AND predicted = 1) AS tp, count(*) FILTER (y = 0 AND predicted = 1) AS fp,
         count(*) FILTER (y = 1 AND predicted = 0) AS fn, count(*) FILTER (y = 0 AND predicted = 0) AS tn,
         avg(abs(y - predicted)) AS mae, avg(-ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) AS log_loss
  FROM sales),
results AS (
  SELECT 1 AS seq, 'auc_roc' AS metric, round(auc, 6) AS value FROM ranked
  UNION ALL SELECT 2, 'f1_macro', round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2, 6) FROM confusion
  UNION ALL SELECT 3, 'accuracy', round((tp + tn) / (tp + tn + fp + fn), 6) FROM confusion
  UNION ALL SELECT 4, 'log_loss', round(log_loss, 6) FROM confusion
  UNION ALL SELECT 5, 'ks_statistic', round(ks, 6) FROM ranked
  UNION ALL SELECT 6, 'gini', round(2 * auc - 1, 6) FROM ranked
  UNION ALL SELECT 7, 'mae', round(mae, 6) FROM confusion)"""


def _sales_results(spark, sf_dir):
    return metrics.evaluate(sales(spark, sf_dir), SALES_METRICS, "y", "predicted", "p")


@query("m_evaluate", f"WITH {_SALES_RESULTS} SELECT seq, metric, value FROM results")
def m_evaluate(spark, sf_dir):
    return _sales_results(spark, sf_dir)


@query("m_thresholds", f"""WITH {_SALES_RESULTS},
limits(metric, threshold, lower) AS (
  VALUES ('auc_roc', 0.8::DOUBLE, false), ('f1_macro', 0.99, false), ('log_loss', 0.7, true), ('mae', 0.01, true), ('rmse', 0.5, true))
SELECT metric, value, threshold, coalesce(CASE WHEN lower THEN value <= threshold ELSE value >= threshold END, false) AS passed,
       CASE WHEN value IS NULL THEN 'metric computation failed' END AS reason
FROM limits LEFT JOIN results USING (metric)""")
def m_thresholds(spark, sf_dir):
    return metrics.threshold_checks(_sales_results(spark, sf_dir), SALES_LIMITS)


@query("m_summary", f"""WITH {_SALES_RESULTS},
limits(metric, threshold, shown, lower) AS (
  VALUES ('auc_roc', 0.8::DOUBLE, '0.8', false), ('f1_macro', 0.99, '0.99', false), ('log_loss', 0.7, '0.7', true), ('mae', 0.01, '0.01', true)),
lines AS (
  SELECT seq, CASE WHEN threshold IS NULL THEN '  ℹ️  ' || metric || ': ' || printf('%.4f', round(value, 4))
              ELSE '  ' || CASE WHEN CASE WHEN lower THEN value <= threshold ELSE value >= threshold END THEN '✅' ELSE '❌' END
                   || ' ' || metric || ': ' || printf('%.4f', round(value, 4)) || ' (threshold: ' || shown || ')' END AS line
  FROM results LEFT JOIN limits USING (metric))
SELECT string_agg(line, chr(10) ORDER BY seq) AS summary FROM lines""")
def m_summary(spark, sf_dir):
    return metrics.metric_summary(_sales_results(spark, sf_dir), SALES_LIMITS)


@query("m_by_run_date", f"""WITH {_SALES}, {_rank_sql('sales', 'y', 'p', 'run_date')},
confusion AS (
  SELECT run_date, avg(CAST(y = predicted AS INT)) AS accuracy, avg(-ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) AS log_loss
  FROM sales GROUP BY run_date)
SELECT run_date, 1 AS seq, 'auc_roc' AS metric, round(auc, 6) AS value FROM ranked
UNION ALL SELECT run_date, 2, 'ks_statistic', round(ks, 6) FROM ranked
UNION ALL SELECT run_date, 3, 'accuracy', round(accuracy, 6) FROM confusion
UNION ALL SELECT run_date, 4, 'log_loss', round(log_loss, 6) FROM confusion""")
def m_by_run_date(spark, sf_dir):
    names = ["auc_roc", "ks_statistic", "accuracy", "log_loss"]
    return metrics.evaluate(sales(spark, sf_dir), names, "y", "predicted", "p", by=["run_date"])


@query("m_daily_events", f"""WITH {BATCH_SQL},
points AS (SELECT run_date, is_error AS y, value / 500 AS p FROM batch), {_rank_sql('points', 'y', 'p', 'run_date')}
SELECT run_date, round(auc, 6) AS auc_roc, round(ks, 6) AS ks_statistic, round(2 * auc - 1, 6) AS gini FROM ranked""")
def m_daily_events(spark, sf_dir):
    points = events_batch(spark, sf_dir).select("run_date", F.col("is_error").alias("y"), (F.col("value") / 500).alias("p"))
    return metrics.ranked_metrics(points, "y", "p", ["run_date"]).withColumns(
        rounded("auc_roc", "ks_statistic", "gini")
    )


def judged(spark, sf_dir):
    """Labelled documents with the scores of two model versions."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.col("quality").alias("y"),
        logistic(F.ln(F.col("n_chars") + 1) - 6).alias("score_now"),
        logistic(F.col("n_chars") / 1500.0 - 1).alias("score_new"),
    )


_JUDGED = """
judged AS (
  SELECT quality AS y, 1 / (1 + exp(-(ln(n_chars + 1) - 6))) AS score_now, 1 / (1 + exp(-(n_chars / 1500.0 - 1))) AS score_new
  FROM labels JOIN documents USING (doc_id)),
versions AS (
  SELECT y, 'production' AS version, score_now AS score FROM judged UNION ALL SELECT y, 'candidate', score_new FROM judged)"""


@query("m_candidate_vs_production", f"""WITH {_JUDGED}, {_rank_sql('versions', 'y', 'score', 'version')},
plain AS (SELECT version, avg(CAST(y = CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS INT)) AS accuracy FROM versions GROUP BY version),
results AS (
  SELECT version, 'auc_roc' AS metric, round(auc, 6) AS value FROM ranked
  UNION ALL SELECT version, 'ks_statistic', round(ks, 6) FROM ranked
  UNION ALL SELECT version, 'accuracy', round(accuracy, 6) FROM plain),
wide AS (
  SELECT metric, max(value) FILTER (version = 'candidate') AS candidate, max(value) FILTER (version = 'production') AS production
  FROM results GROUP BY metric)
SELECT metric, candidate, production, round(candidate - production, 6) AS delta FROM wide""")
def m_candidate_vs_production(spark, sf_dir):
    versions = {"candidate": "score_new", "production": "score_now"}
    return metrics.compare_versions(judged(spark, sf_dir), versions, ["auc_roc", "ks_statistic", "accuracy"], "y")


@query("m_f1_mixed_types", f"""WITH {_SALES}, statuses AS (SELECT y, predicted FROM sales), {_LABELS}
SELECT round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted,
       round(avg(prec), 6) AS precision_macro, round(avg(rec), 6) AS recall_macro FROM per_class""")
def m_f1_mixed_types(spark, sf_dir):
    """Truth is an int, the prediction a double: 1 and 1.0 are one label."""
    rows = sales(spark, sf_dir).withColumn("predicted", F.col("predicted").cast("double"))
    names = ["f1_macro", "f1_weighted", "precision_macro", "recall_macro"]
    return metrics.confusion_metrics(rows, "y", "predicted").withColumns(rounded(*names))


def _worded(spark, sf_dir):
    return sales(spark, sf_dir).withColumn("y", F.when(F.col("y") == 1, "yes").otherwise("no"))


@query("m_auc_text_labels", f"""WITH {_SALES}, {_rank_sql('sales', 'y', 'p')}
SELECT 1 AS seq, 'auc_roc' AS metric, round(auc, 6) AS value FROM ranked
UNION ALL SELECT 2, 'gini', round(2 * auc - 1, 6) FROM ranked""")
def m_auc_text_labels(spark, sf_dir):
    """Of two words the greater is the positive class."""
    return metrics.evaluate(_worded(spark, sf_dir), ["auc_roc", "gini"], "y", None, "p")


@query("m_ks_text_labels", f"""WITH {_SALES}
SELECT 1 AS seq, 'ks_statistic' AS metric, CAST(max(CASE WHEN y IN (0, 1) THEN 0 END) AS DOUBLE) AS value FROM sales""")
def m_ks_text_labels(spark, sf_dir):
    """Words are neither label 1 nor label 0: no gap."""
    return metrics.evaluate(_worded(spark, sf_dir), ["ks_statistic"], "y", None, "p")


@query("m_custom_metric", f"""WITH {_SALES}
SELECT 1 AS seq, 'accuracy' AS metric, round(avg(CAST(y = predicted AS INT)), 6) AS value FROM sales
UNION ALL SELECT 2, 'mean_bias', round(avg(p - y), 6) FROM sales""")
def m_custom_metric(spark, sf_dir):
    """A metric that a project adds, next to a built-in one."""
    add_metric("mean_bias", lambda y_true, y_pred, y_proba: F.avg(F.col(y_proba) - F.col(y_true)), lower_is_better=True)
    return metrics.evaluate(sales(spark, sf_dir), ["accuracy", "mean_bias"], "y", "predicted", "p")


@query("m_bool_labels", f"WITH {_SALES_RESULTS} SELECT seq, metric, value FROM results")
def m_bool_labels(spark, sf_dir):
    """Truth and prediction are booleans; every metric is that of 0 and 1."""
    rows = sales(spark, sf_dir).withColumns({"y": F.col("y") == 1, "predicted": F.col("predicted") == 1})
    return metrics.evaluate(rows, SALES_METRICS, "y", "predicted", "p")


def _average_precision(tied):
    return {"area": F.sum(tied.pos / tied.pos_all * (tied.pos_above / (tied.pos_above + tied.neg_above)))}


def _best_tenth(tied):
    """Positives in the best tenth of the rows; of the score on which the tenth ends a share counts."""
    here, above = tied.pos + tied.neg, tied.pos_above + tied.neg_above
    room = 0.1 * (tied.pos_all + tied.neg_all) - (above - here)
    return {"hits": F.sum(tied.pos * F.least(F.greatest(room / here, F.lit(0.0)), F.lit(1.0))), "all": F.max(tied.pos_all)}


def _price_caught(tied):
    """The greatest lead of the price above a score over the share of rows above it."""
    rows = (tied.pos_above + tied.neg_above) / (tied.pos_all + tied.neg_all)
    return {"lead": F.max(tied.sums_above["price"] / tied.sums_all["price"] - rows)}


@query("m_custom_ranked", f"""WITH {_SALES.replace("AS y, p,", "AS y, p, l_extendedprice AS price,")},
tied AS (SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg, sum(price) AS price FROM sales GROUP BY p),
above AS (
  SELECT *, sum(pos) OVER w AS pos_above, sum(neg) OVER w AS neg_above, sum(price) OVER w AS price_above,
         sum(pos) OVER () AS pos_all, sum(neg) OVER () AS neg_all, sum(price) OVER () AS price_all
  FROM tied WINDOW w AS (ORDER BY p DESC)),
parts AS (
  SELECT sum(pos / pos_all * (pos_above / (pos_above + neg_above))) AS area,
         sum(pos * least(greatest((0.1 * (pos_all + neg_all) - (pos_above + neg_above - pos - neg)) / (pos + neg), 0), 1)) / max(pos_all) / 0.1 AS lift,
         max(price_above / price_all - (pos_above + neg_above) / (pos_all + neg_all)) AS caught
  FROM above)
SELECT 1 AS seq, 'average_precision' AS metric, round(area, 6) AS value FROM parts
UNION ALL SELECT 2, 'lift_at_10', round(lift, 6) FROM parts
UNION ALL SELECT 3, 'price_caught', round(caught, 6) FROM parts
UNION ALL SELECT 4, 'accuracy', round(avg(CAST(y = predicted AS INT)), 6) FROM sales""")
def m_custom_ranked(spark, sf_dir):
    """Metrics over scores in order that a project adds, next to a built-in one."""
    add_ranked_metric("average_precision", _average_precision, lambda parts: parts["area"])
    add_ranked_metric("lift_at_10", _best_tenth, lambda parts: parts["hits"] / parts["all"] / 0.1)
    add_ranked_metric(
        "price_caught", _price_caught, lambda parts: parts["lead"],
        per_row={"price": lambda y_true, y_pred, y_proba: F.col("l_extendedprice")},
    )
    score = logistic(F.col("l_extendedprice") / 20000 - 1.8)
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") >= 25).cast("int").alias("y"), score.alias("p"), (score >= 0.5).cast("int").alias("predicted"), "l_extendedprice"
    )
    return metrics.evaluate(rows, ["average_precision", "lift_at_10", "price_caught", "accuracy"], "y", "predicted", "p")
