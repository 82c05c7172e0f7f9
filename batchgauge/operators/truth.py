"""Labels that arrive later, and quality by date from states that add up.

Labels of a run come `lag_days` after it, and not all at once. Each arrival is joined with the stored scores of
its dates only, rows that have their label already being left out, and becomes two tables: the labelled rows, and a
state per date that is enough for every metric: pairs of label and prediction, counts of either label per score cell, and
sums of errors. Quality of a date is the sum of its states, so a late label costs a read of its own date's
scores and of a few thousand counts. An arrival that is taken again replaces what it wrote.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from batchgauge.config import ADDED_METRICS, METRIC_NAMES, Project
from batchgauge.functions.columns import col, missing
from batchgauge.operators import metrics
from batchgauge.operators.monitor import last_success

#: Scores are counted in cells of this many decimals: ranking metrics are those of the rounded scores.
SCORE_DIGITS = 4
#: A score of at least this is a prediction of 1, where no column holds predictions.
CUT = 0.5

STATE = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("arrived", T.DateType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("kind", T.StringType()),   # pair, score, or sum
    T.StructField("label", T.StringType()),  # the label of a pair or score, the name of a sum
    T.StructField("told", T.StringType()),   # the prediction of a pair
    T.StructField("score", T.DoubleType()),  # the cell of a score
    T.StructField("n", T.LongType()),
    T.StructField("total", T.DoubleType()),
])
_STATE, _TRUTH = "quality_state", "{}_truth"


def _truth_schema(result: T.StructType, ids) -> T.StructType:
    return T.StructType([
        *[T.StructField(i, result[i].dataType) for i in ids],
        T.StructField("run_date", T.DateType()), T.StructField("y_true", T.DoubleType()),
        T.StructField("y_pred", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("arrived", T.DateType()),
    ])


def add_labels(
    store, project: Project, labels: DataFrame, as_of: date, prediction: str | None = None, score: str | None = None,
    label_date: str = "label_date",
) -> None:
    """Take the labels (ids, label, and ``label_date``, else ``as_of``) that arrive on a day.

    A label belongs to the run ``lag_days`` before its date. ``prediction`` and ``score`` name result columns; without the
    first, a score of ``CUT`` or more predicts 1. Missing labels, labels of rows that were never scored and labels of rows that
    have one are left out; of two for a row in one arrival the greater counts. Labels are numbers or booleans.
    """
    spec, ids = project.evaluation.ground_truth, list(project.schema.id_columns)
    result = store.read(project.output.target_table)
    score = score or project.schema.output_columns[0]
    labels = metrics.plain_labels(labels, spec.label_column)
    dated = col(label_date).cast("date") if label_date in labels.columns else F.lit(as_of)
    known = (
        labels.filter(~missing(labels, spec.label_column))
        .select(*[col(i) for i in ids], F.date_sub(dated, spec.lag_days).alias("run_date"),
                col(spec.label_column).cast("double").alias("y_true"))
        .groupBy(*[col(i) for i in ids], "run_date").agg(F.max("y_true").alias("y_true"))
    )
    # Collected: the dates that these labels are for. Only their partitions are read.
    dates = [r[0] for r in known.select("run_date").distinct().collect()]
    table, schema = _TRUTH.format(project.output.target_table), _truth_schema(result.schema, ids)
    store.ensure(table, schema, ["arrived"])
    store.ensure(_STATE, STATE, ["project_id", "arrived"])
    had = store.read(table, schema).filter(F.col("run_date").isin(dates) & (F.col("arrived") != F.lit(as_of)))
    told = col(prediction).cast("double") if prediction else (col(score) >= CUT).cast("double")
    scored = result.filter(F.col("run_date").isin(dates)).select(
        *[col(i) for i in ids], "run_date", told.alias("y_pred"), F.when(~missing(result, score), col(score).cast("double")).alias("score")
    )
    fresh = scored.join(known, [*ids, "run_date"]).join(had.select(*[col(i) for i in ids], "run_date"), [*ids, "run_date"], "left_anti")
    fresh = fresh.withColumn("arrived", F.lit(as_of)).select(*[col(n) for n in schema.names])
    _replace(store, table, fresh, ["arrived"], f"arrived={as_of.isoformat()}")
    rows = store.read(table, schema).filter(F.col("arrived") == F.lit(as_of))
    states = states_of(rows).withColumns({"project_id": F.lit(project.project_id), "arrived": F.lit(as_of)})
    _replace(
        store, _STATE, states.select(*STATE.names), ["project_id", "arrived"],
        f"project_id={project.project_id}/arrived={as_of.isoformat()}",
    )


def _replace(store, table: str, rows: DataFrame, partition: list[str], folder: str) -> None:
    """Overwrite one partition as a whole, with no rows too."""
    path = store.path(table)
    if rows.isEmpty():
        empty = store.spark.createDataFrame([], T.StructType([f for f in rows.schema if f.name not in partition]))
        empty.write.mode("overwrite").parquet(f"{path}/{folder}")
    else:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def states_of(rows: DataFrame) -> DataFrame:
    """run_date, kind, label, told, score, n, total of rows (run_date, y_true, y_pred, score): one aggregate for all kinds.

    A row goes into one pair, one score cell and the sums, all counted in one shuffle.
    """
    p = F.least(F.greatest("score", F.lit(metrics.LOG_LOSS_EPS)), F.lit(1 - metrics.LOG_LOSS_EPS))
    gap = F.col("y_true") - F.col("y_pred")
    loss = F.when(F.col("y_true") == 1, -F.ln(p)).when(F.col("y_true") == 0, -F.ln(1 - p))
    text, none = (lambda c: F.col(c).cast("string")), F.lit(None).cast("string")

    def part(kind: str, label: Column, told: Column, score: Column, total: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), label.alias("label"), told.alias("told"), score.alias("score"), total.cast("double").alias("total")
        )

    nothing = F.lit(None).cast("double")
    sums = {"squared": gap * gap, "absolute": F.abs(gap), "true": F.col("y_true"), "true_squared": F.col("y_true") ** 2, "loss": loss}
    parts = F.array(
        part("pair", text("y_true"), text("y_pred"), nothing, F.lit(0.0)),
        part("score", text("y_true"), none, F.round("score", SCORE_DIGITS), F.lit(0.0)),
        *[part("sum", F.lit(name), none, nothing, value) for name, value in sums.items()],
    )
    return rows.select("run_date", F.inline(parts)).groupBy("run_date", "kind", "label", "told", "score").agg(
        F.count("*").alias("n"), F.when(F.count("total") == F.count("*"), F.sum("total")).alias("total")
    )


def _states(store, project: Project) -> DataFrame:
    own = store.read(_STATE, STATE).filter(F.col("project_id") == project.project_id)
    whole = F.count_if(F.col("total").isNull()) == 0
    return own.groupBy("run_date", "kind", "label", "told", "score").agg(
        F.sum("n").alias("n"), F.when(whole, F.sum("total")).alias("total")
    )


def quality_over_time(store, project: Project) -> DataFrame:
    """run_date, n_labelled, metric, value, threshold, passed of every date that has labels, from the states alone.

    Metrics added as aggregates over rows are NULL here, as states hold no rows.
    """
    by, states = ["run_date"], _states(store, project)
    pairs = states.filter("kind = 'pair'").select("run_date", F.col("label").alias("y_true"), F.col("told").alias("y_pred"), "n")
    same = F.coalesce(F.col("y_true") == F.col("y_pred"), F.lit(False))
    accuracy = pairs.groupBy("run_date").agg(
        F.sum("n").alias("n_labelled"),
        F.when(F.count_if(F.col("y_pred").isNull()) == 0, F.sum(F.when(same, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"),
    )
    averaged = metrics.averaged_label_scores(metrics.label_scores(pairs, by), by)
    is_one, is_zero = F.col("label").cast("double") == 1, F.col("label").cast("double") == 0

    def rows_where(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(F.lit(0)))

    tied = states.filter("kind = 'score'").groupBy("run_date", F.col("score").alias("value")).agg(
        rows_where(is_one).alias("pos"), rows_where(is_zero).alias("neg"), rows_where(~is_one & ~is_zero).alias("other")
    ).withColumns({"one": F.col("pos"), "zero": F.col("neg")})
    ranked = metrics.area_and_gap(tied, by)
    total = {
        name: F.max(F.when(F.col("label") == name, F.col("total")))
        for name in ("squared", "absolute", "true", "true_squared", "loss")
    }
    sums = states.filter("kind = 'sum'").groupBy("run_date").agg(F.max("n").alias("m"), *[c.alias(k) for k, c in total.items()])
    mse, spread = F.col("squared") / F.col("m"), F.col("true_squared") / F.col("m") - (F.col("true") / F.col("m")) ** 2
    sums = sums.select(
        "run_date", mse.alias("mse"), F.sqrt(mse).alias("rmse"), (F.col("absolute") / F.col("m")).alias("mae"),
        F.when(F.col("m") > 1, F.when(spread > 0, 1 - mse / F.nullif(spread, F.lit(0.0)))
               .otherwise(F.when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))).alias("r2"),
        # a class alone has no loss to speak of
        F.when((F.col("true") > 0) & (F.col("true") < F.col("m")), F.col("loss") / F.col("m")).alias("log_loss"),
    )
    # a row per date on every side
    wide = accuracy.join(averaged, by).join(ranked, by).join(sums, by)
    spec = project.evaluation
    known = [m for m in spec.metrics if m in METRIC_NAMES]
    unknown = [m for m in spec.metrics if m in ADDED_METRICS]
    cells = [F.struct(F.lit(m).alias("metric"), F.round(F.col(m), 6).alias("value")) for m in known]
    cells += [F.struct(F.lit(m).alias("metric"), F.lit(None).cast("double").alias("value")) for m in unknown]
    long = wide.select("run_date", "n_labelled", F.inline(F.array(*cells)))
    limit = F.lit(None).cast("double")
    for name, t in spec.thresholds.items():
        limit = F.when(F.col("metric") == name, F.lit(float(t))).otherwise(limit)
    lower = F.col("metric").isin(*metrics.lower_is_better())
    met = F.when(lower, F.col("value") <= F.col("threshold")).otherwise(F.col("value") >= F.col("threshold"))
    return long.withColumn("threshold", limit).withColumn(
        "passed", F.when(F.col("threshold").isNotNull(), F.coalesce(met, F.lit(False)))
    )


def label_backlog(store, project: Project, as_of: date) -> DataFrame:
    """run_date, n_scored, n_labelled, due_on, overdue of every logged date: from the run log and the states, without the scores."""
    spec = project.evaluation.ground_truth
    runs = last_success(store.read("run_log").filter(F.col("project_id") == project.project_id))
    done = _states(store, project).filter("kind = 'pair'").groupBy("run_date").agg(F.sum("n").alias("n_labelled"))
    labelled = F.coalesce("n_labelled", F.lit(0))
    due = F.date_add("run_date", spec.lag_days)
    return runs.join(done, "run_date", "left").select(
        "run_date", F.col("row_count").alias("n_scored"), labelled.alias("n_labelled"), due.alias("due_on"),
        ((labelled < F.col("row_count")) & (due <= F.lit(as_of))).alias("overdue"),
    )
