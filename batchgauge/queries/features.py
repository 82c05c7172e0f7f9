"""Feature expressions, labels and training."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgauge.functions.columns import indicator, log_floor, run_date_range, safe_ratio
from batchgauge.functions.quantiles import exact_quantiles
from batchgauge.operators import metrics, prep, sampling, views
from batchgauge.queries.registry import query, rounded, table

# Parts lose their price, and customers their balance, in places, so that missing cells occur.
_PARTS = """
parts AS (SELECT p_partkey, p_size, p_type, CASE WHEN p_size <> 7 THEN p_retailprice END AS price FROM part)"""


def _parts(spark, sf_dir):
    price = F.when(F.col("p_size") != 7, F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", price.alias("price"))


@query("fe_safe_ratio", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_tax / nullif(l_discount, 0), 6) AS ratio FROM lineitem""")
def fe_safe_ratio(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(safe_ratio(F.col("l_tax"), F.col("l_discount")), 6).alias("ratio"),
    )


@query("fe_log_floor", """
SELECT c_custkey, round(CASE WHEN balance IS NOT NULL THEN ln(greatest(balance, 1)) END, 6) AS log_balance
FROM (SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS balance FROM customer)""")
def fe_log_floor(spark, sf_dir):
    balance = F.when(F.col("c_nationkey") != 3, F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(log_floor(balance), 6).alias("log_balance"))


@query("fe_indicator", """
SELECT o_orderkey, CASE WHEN status = 'F' THEN 1 ELSE 0 END AS is_f
FROM (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS status FROM orders)""")
def fe_indicator(spark, sf_dir):
    status = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select("o_orderkey", indicator(status, "F").alias("is_f"))


@query("fe_scaler", """
SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal, c_nationkey
FROM customer""")
def fe_scaler(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return prep.apply_scaler(rows, prep.fit_scaler(rows, ["c_acctbal"])).withColumns(rounded("c_acctbal"))


@query("fe_impute_median", f"""WITH {_PARTS}
SELECT p_partkey, round(coalesce(price, (SELECT median(price) FROM parts)), 6) AS price FROM parts""")
def fe_impute_median(spark, sf_dir):
    rows = prep.impute_median(_parts(spark, sf_dir), ["price"])
    return rows.select("p_partkey", "price").withColumns(rounded("price"))


@query("fe_quantiles", """
WITH cells AS (SELECT 'quantity' AS "column", l_quantity AS value FROM lineitem
  UNION ALL SELECT 'price', l_extendedprice FROM lineitem UNION ALL SELECT 'tax', l_tax FROM lineitem)
SELECT "column", count(*) AS n, round(quantile_cont(value, 0.05), 6) AS q05, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.95), 6) AS q95 FROM cells GROUP BY "column" """)
def fe_quantiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("tax")
    )
    q = exact_quantiles(lines, lines.columns, [0.05, 0.5, 0.95])
    return q.select("column", "n", *[
        F.round(F.col("quantiles")[i], 6).alias(name) for i, name in enumerate(["q05", "q50", "q95"])
    ])


@query("fe_minmax", f"""WITH {_PARTS}
SELECT p_partkey, round((price - (SELECT min(price) FROM parts)) / (SELECT max(price) - min(price) FROM parts), 6) AS price,
       0.5::DOUBLE AS constant
FROM parts""")
def fe_minmax(spark, sf_dir):
    rows = _parts(spark, sf_dir).select("p_partkey", "price", F.lit(4.0).alias("constant"))
    return prep.min_max(rows, ["price", "constant"]).withColumns(rounded("price"))


@query("fe_logistic_q95", """
SELECT o_orderkey, round(1 / (1 + exp(-10 * (x - q))), 6) AS probability
FROM (SELECT o_orderkey, o_totalprice / 500000 AS x, (SELECT quantile_cont(o_totalprice / 500000, 0.95) FROM orders) AS q FROM orders)""")
def fe_logistic_q95(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 500000).alias("x"))
    return rows.withColumn("probability", prep.logistic_from_quantile(rows, "x")).drop("x").withColumns(
        rounded("probability")
    )


@query("fe_date_sequence", """
SELECT user_id, CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS run_date
FROM events GROUP BY user_id""")
def fe_date_sequence(spark, sf_dir):
    """Every day of each user's active range."""
    ranges = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b")
    )
    return ranges.select("user_id", F.explode(run_date_range(F.col("a"), F.col("b"))).alias("run_date"))


WEIGHTS = {"l_quantity": 0.3, "l_discount": -0.2, "l_extendedprice": 0.15, "l_tax": -0.1}
_KEY_TEXT = "l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey"
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _draw(salt: str) -> str:
    return f"(CAST(('0x' || substr(md5({_KEY_TEXT} || '|42{salt}'), 1, 12)) AS BIGINT) + 0.5) / 281474976710656.0"


def _unit(c: str) -> str:
    return f"({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem)"


_LABELLED = f"""
risky AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_draw('label')} AS draw,
         {' + '.join(f"{w} * {_unit(c)}" for c, w in WEIGHTS.items())}
         + 0.15 * sqrt(-2 * ln({_draw('u')})) * cos(6.283185307179586 * {_draw('v')}) AS risk
  FROM lineitem),
labelled AS (
  SELECT *, 1 / (1 + exp(-10 * (risk - (SELECT quantile_cont(risk, 0.95) FROM risky)))) AS probability FROM risky)"""


def _labelled(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_quantity", "l_discount", "l_extendedprice", "l_tax")
    return prep.synthetic_labels(lines, WEIGHTS, LINE_KEYS)


@query("label_synthetic", f"""WITH {_LABELLED}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(risk, 6) AS risk, round(probability, 6) AS probability,
       CASE WHEN draw < probability THEN 1 ELSE 0 END AS label FROM labelled""")
def label_synthetic(spark, sf_dir):
    return _labelled(spark, sf_dir).select(*LINE_KEYS, "risk", "probability", "label").withColumns(
        rounded("risk", "probability")
    )


@query("label_balance", f"""WITH {_LABELLED}, drawn AS (SELECT CASE WHEN draw < probability THEN 1 ELSE 0 END AS label FROM labelled)
SELECT count(*) AS n, sum(label) AS positives, round(avg(label), 6) AS rate FROM drawn""")
def label_balance(spark, sf_dir):
    return prep.label_balance(_labelled(spark, sf_dir), "label").withColumns(rounded("rate"))


@query("split_stratified", """
SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || '|42'), o_orderkey) AS rn,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)""")
def split_stratified(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_split(orders, "o_orderstatus", ["o_orderkey"])


TRAIN_FEATURES = ["value", "hour", "k"]
# The library's default is 200 rounds; the registered query trains a short ensemble.
TRAIN_ROUNDS = 5


def _trained(spark, sf_dir):
    from batchgauge.queries.inputs import events_batch

    batch = events_batch(spark, sf_dir).select("event_id", *TRAIN_FEATURES, (F.col("value") + F.col("k") > 70).cast("int").alias("label"))
    split = sampling.stratified_split(batch, "label", ["event_id"])
    model = prep.train_boosted(split.filter("split = 'train'"), TRAIN_FEATURES, "label", TRAIN_ROUNDS)
    return model, split.filter("split = 'test'")


@query("train_gbt_auc")
def train_gbt_auc(spark, sf_dir):
    model, held_out = _trained(spark, sf_dir)
    scored = prep.score_boosted(model, held_out, TRAIN_FEATURES)
    return metrics.ranked_metrics(scored, "label", "score").withColumns(rounded("auc_roc", "ks_statistic", "gini", digits=4))


@query("train_importance")
def train_importance(spark, sf_dir):
    """A top-5 report of gain per feature."""
    model, _ = _trained(spark, sf_dir)
    return views.top_rows(prep.feature_importance(spark, model, TRAIN_FEATURES), "importance", 5, "feature")
