"""Evaluation metrics as aggregates, for all groups of a batch at once.

Three passes cover the thirteen metrics: one fused aggregate, one confusion table,
and one count of scores that is then ranked. A metric whose inputs are missing or degenerate is NULL,
which fails its threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from batchgauge.config import ADDED_METRICS, RANKED_METRICS, EvalSpec, lower_is_better
from batchgauge.functions.columns import col, missing
from batchgauge.functions.ranges import ROWS_PER_RANGE, running_sums
from batchgauge.session import written

_FUSED = ("accuracy", "log_loss", "mse", "rmse", "r2", "mae")
_CONFUSION = ("f1_macro", "f1_weighted", "precision_macro", "recall_macro")
_RANKED = ("auc_roc", "ks_statistic", "gini")

# Fixed value: why a threshold fails that has no value.
NO_VALUE = "metric computation failed"
# Fixed value: scores are kept this far from 0 and 1 before the logarithm.
LOG_LOSS_EPS = 2.220446049250313e-16

Scores = str | Mapping[object, str]

#: Groups whose label bounds go to every task.
BROADCAST_GROUPS = 100_000


def plain_labels(df: DataFrame, *names: str | None) -> DataFrame:
    """``df`` with boolean columns among ``names`` as 0 and 1."""
    flags = [n for n in names if n is not None and isinstance(df.schema[n].dataType, BooleanType)]
    return df.withColumns({n: col(n).cast("int") for n in flags}) if flags else df


def _valid(df: DataFrame, names: Sequence[str]) -> Column:
    """True for a group in which none of the columns is ever missing."""
    bad = F.lit(False)
    for n in names:
        bad = bad | missing(df, n)
    return F.count_if(bad) == 0


def pointwise_metrics(
    df: DataFrame, y_true: str, y_pred: str | None, y_proba: Scores | None, wanted: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """by… and one column per wanted metric of accuracy, log_loss, mse, rmse, r2, mae."""
    df = plain_labels(df, y_true, y_pred)
    out: dict[str, Column] = {}
    t = col(y_true)
    if y_pred is not None:
        p, whole = col(y_pred), _valid(df, [y_true, y_pred])
        # text never equals a number; a comparison would try to cast it
        same = F.lit(False) if _is_text(df, y_true) != _is_text(df, y_pred) else t == p
        out["accuracy"] = F.when(whole, F.avg(same.cast("double")))
        if _numeric_pair(df, y_true, y_pred):
            gap = t.cast("double") - p.cast("double")
            mse = F.avg(gap * gap)
            spread = F.var_pop(t.cast("double"))  # centred: no cancellation on large values
            flat = F.when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
            out["mse"] = F.when(whole, mse)
            out["rmse"] = F.when(whole, F.sqrt(mse))
            out["mae"] = F.when(whole, F.avg(F.abs(gap)))
            r2 = F.when(spread == 0, flat).otherwise(1 - mse / F.nullif(spread, F.lit(0.0)))
            out["r2"] = F.when(whole & (F.count("*") > 1), r2)
    if y_proba is not None:
        out["log_loss"] = _log_loss(df, y_true, y_proba)
    picked = {m: out.get(m, F.lit(None).cast("double")) for m in wanted}
    # The leading count keeps this an aggregate when every wanted metric is a constant NULL.
    return df.groupBy(*by).agg(
        F.count("*").alias("_n"), *[c.alias(m) for m, c in picked.items()]
    ).drop("_n")


def _numeric_pair(df: DataFrame, *names: str) -> bool:
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = [df.schema[n].dataType.simpleString() for n in names]
    return all(t in numeric or t.startswith("decimal") for t in types)


def _log_loss(df: DataFrame, y_true: str, y_proba: Scores) -> Column:
    t = col(y_true)
    if isinstance(y_proba, str):
        of_true = F.when(t == 1, col(y_proba)).when(t == 0, 1 - col(y_proba))
        used = [y_true, y_proba]
    else:
        of_true = F.lit(None).cast("double")
        for label, name in y_proba.items():
            of_true = F.when(t == F.lit(label), col(name)).otherwise(of_true)
        used = [y_true, *y_proba.values()]
    clipped = F.least(F.greatest(of_true, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    sound = _valid(df, used) & (F.count_if(of_true.isNull()) == 0) & (F.min(t) != F.max(t))
    return F.when(sound, F.avg(-F.ln(clipped)))


def confusion_counts(df: DataFrame, y_true: str, y_pred: str, by: Sequence[str] = ()) -> DataFrame:
    """by…, y_true, y_pred, n: classes squared rows per group."""
    df = plain_labels(df, y_true, y_pred)
    truth, told = col(y_true), col(y_pred)
    kinds = [df.schema[c].dataType for c in (y_true, y_pred)]
    if kinds[0] != kinds[1] and all(isinstance(k, NumericType) for k in kinds):
        truth, told = truth.cast("double"), told.cast("double")  # 1 and 1.0 are one label
    return df.groupBy(
        *by, F.when(~missing(df, y_true), truth).alias("y_true"),
        F.when(~missing(df, y_pred), told).alias("y_pred"),
    ).agg(F.count("*").alias("n"))


def label_scores(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by…, label, support, precision, recall, f1, with 0 where a division has no rows."""
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    n, none = F.col("n"), F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("y_true").cast("string").alias("label"), n.alias("true_n"), none.alias("pred_n"),
                 hit.cast("long").alias("hit_n"), F.col("y_pred").isNull().alias("bad")),
        F.struct(F.col("y_pred").cast("string").alias("label"), none.alias("true_n"), n.alias("pred_n"),
                 none.alias("hit_n"), F.col("y_true").isNull().alias("bad")),
    )
    per_label = confusion.select(*by, F.inline(sides)).groupBy(*by, "label").agg(
        F.sum("true_n").alias("support"), F.sum("pred_n").alias("predicted"), F.sum("hit_n").alias("hits"),
        (F.max("bad") | F.col("label").isNull()).alias("bad"),
    )
    hits = F.col("hits")
    return per_label.select(
        *by, "label", "support", "bad",
        F.coalesce(hits / F.nullif(F.col("predicted"), F.lit(0)), F.lit(0.0)).alias("precision"),
        F.coalesce(hits / F.nullif(F.col("support"), F.lit(0)), F.lit(0.0)).alias("recall"),
        F.coalesce(2 * hits / F.nullif(F.col("support") + F.col("predicted"), F.lit(0)), F.lit(0.0)).alias("f1"),
    )


def confusion_metrics(
    df: DataFrame, y_true: str, y_pred: str, by: Sequence[str] = ()
) -> DataFrame:
    """by…, f1_macro, f1_weighted, precision_macro, recall_macro; NULL if only one side is text."""
    if _is_text(df, y_true) != _is_text(df, y_pred):
        none = [F.lit(None).cast("double").alias(m) for m in _CONFUSION]
        return df.groupBy(*by).agg(F.count("*").alias("_n")).select(*by, *none)
    return averaged_label_scores(label_scores(confusion_counts(df, y_true, y_pred, by), by), by)


def averaged_label_scores(labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by…, f1_macro, f1_weighted, precision_macro, recall_macro of the scores per label."""
    good = F.count_if("bad") == 0
    return labels.groupBy(*by).agg(
        F.when(good, F.avg("f1")).alias("f1_macro"),
        F.when(good, F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support"))).alias("f1_weighted"),
        F.when(good, F.avg("precision")).alias("precision_macro"),
        F.when(good, F.avg("recall")).alias("recall_macro"),
    )


def ranked_metrics(
    df: DataFrame, y_true: str, score: str, by: Sequence[str] = (), positive=1, negative=0,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """by…, auc_roc, ks_statistic, gini of a score against a two-class label.

    Scores are counted per distinct value in one read, so ties of any number are one row. More distinct
    scores than ``rows_per_range`` are summed in ranges, as many as they need.
    """
    df = plain_labels(df, y_true)
    t = col(y_true)
    points = df.select(
        *[col(b) for b in by], _score(df, score).alias("value"),
        F.coalesce((t == F.lit(positive)).cast("int"), F.lit(0)).alias("pos"),
        F.coalesce((t == F.lit(negative)).cast("int"), F.lit(0)).alias("neg"),
    )
    tied = points.groupBy(*by, "value").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count_if(F.col("pos") + F.col("neg") == 0).alias("other"),
    )
    return area_and_gap(tied.withColumns({"one": F.col("pos"), "zero": F.col("neg")}), by, rows_per_range)


def _score(df: DataFrame, score: str) -> Column:
    return F.when(~missing(df, score), col(score).cast("double"))


def area_and_gap(tied: DataFrame, by: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """by…, auc_roc, ks_statistic, gini from counts per distinct score (by…, value, pos, neg, other, one, zero).

    A NULL value holds the rows without a score. pos and neg are the two classes, ``other`` the rows of neither; one and zero are
    those that ks_statistic compares.
    """
    ordered = running_sums(written(tied, "tied-scores"), ["value"], ["pos", "neg", "one", "zero"], by, rows_per_range, "scores")
    unscored = F.col("value").isNull()
    all_of = {n: F.nullif(F.col(f"{n}_all"), F.lit(0)) for n in ("pos", "neg", "one", "zero")}
    neg_before = F.col("neg_upto") - F.col("neg")
    share = F.col("pos") / all_of["pos"] * ((neg_before + F.col("neg") / 2) / all_of["neg"])
    gap = F.abs(F.col("one_upto") / all_of["one"] - F.col("zero_upto") / all_of["zero"])
    out = ordered.groupBy(*by).agg(
        F.sum(share).alias("auc"), F.max(gap).alias("gap"),
        F.coalesce(F.sum(F.when(unscored, F.col("pos") + F.col("neg"))), F.lit(0)).alias("bad"),
        F.coalesce(F.sum(F.when(unscored, F.col("one") + F.col("zero"))), F.lit(0)).alias("bad_gap"),
        F.coalesce(F.sum("other"), F.lit(0)).alias("other"),
    )
    auc = F.when((F.col("bad") == 0) & (F.col("other") == 0), F.col("auc"))
    # Without one of the classes the gap is 0; a missing score of either class makes it NULL.
    ks = F.when(F.col("gap").isNull(), F.lit(0.0)).when(F.col("bad_gap") == 0, F.col("gap"))
    return out.select(*by, auc.alias("auc_roc"), ks.alias("ks_statistic"), (2 * auc - 1).alias("gini"))


@dataclass(frozen=True)
class Tied:
    """What a ranked metric knows at one distinct score: rows of either class there, from there upwards, and in all.

    ``sums``, ``sums_above`` and ``sums_all`` hold the metric's own per-row columns the same way.
    """

    value: Column
    pos: Column
    neg: Column
    pos_above: Column
    neg_above: Column
    pos_all: Column
    neg_all: Column
    sums: Mapping[str, Column]
    sums_above: Mapping[str, Column]
    sums_all: Mapping[str, Column]


def labelled_scores(
    df: DataFrame, y_true: str, score: str, by: Sequence[str] = (), sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """(by…, value, pos, neg, other, one, zero, sums…) per distinct score, from one read.

    Of the two labels of a group the greater is positive, whatever their type; one and zero count the numbers 1 and 0.
    """
    df = plain_labels(df, y_true)
    label = F.when(~missing(df, y_true), col(y_true))
    sums = dict(sums or {})
    counted = written(
        df.select(*[col(b) for b in by], _score(df, score).alias("value"), label.alias("label"),
                  *[s.cast("double").alias(f"_sum_{k}") for k, s in sums.items()])
        .groupBy(*by, "value", "label").agg(F.count("*").alias("n"), *[F.sum(f"_sum_{k}").alias(f"_sum_{k}") for k in sums]),
        "labelled-scores",
    )
    bounds = counted.groupBy(*by).agg(F.min("label").alias("low"), F.max("label").alias("high"))
    if by:
        bounds = written(bounds.withColumnsRenamed({b: f"_by_{i}" for i, b in enumerate(by)}), "label-bounds")
        same = [F.col(b).eqNullSafe(F.col(f"_by_{i}")) for i, b in enumerate(by)]
        rows = counted.join(F.broadcast(bounds) if bounds.count() <= BROADCAST_GROUPS else bounds, same)
    else:
        kind = counted.schema["label"].dataType
        rows = counted.withColumns({name: F.lit(value).cast(kind) for name, value in bounds.first().asDict().items()})
    high = F.coalesce(F.col("label") == F.col("high"), F.lit(False))
    low = F.coalesce((F.col("label") == F.col("low")) & (F.col("low") != F.col("high")), F.lit(False))
    text = isinstance(df.schema[y_true].dataType, StringType)

    def number(k: int) -> Column:
        return F.lit(False) if text else F.coalesce(F.col("label").cast("double") == F.lit(float(k)), F.lit(False))

    def rows_where(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(F.lit(0)))

    return rows.groupBy(*by, "value").agg(
        rows_where(high).alias("pos"), rows_where(low).alias("neg"), rows_where(~high & ~low).alias("other"),
        rows_where(number(1)).alias("one"), rows_where(number(0)).alias("zero"),
        *[F.coalesce(F.sum(f"_sum_{k}"), F.lit(0.0)).alias(f"_sum_{k}") for k in sums],
    )


def added_ranked_metrics(
    df: DataFrame, names: Sequence[str], y_true: str, y_pred: str | None, score: str, by: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """by… and one column per metric of ``config.add_ranked_metric``; NULL where a row has no score or no class."""
    rows = {
        f"{i}_{k}": build(y_true, y_pred, score) for i, m in enumerate(names) for k, build in RANKED_METRICS[m].per_row.items()
    }
    tied = written(labelled_scores(df, y_true, score, by, rows), "tied-scores")
    added = [f"_sum_{k}" for k in rows]
    ordered = running_sums(tied, ["value"], ["pos", "neg", *added], by, rows_per_range, "scores")

    def above(name: str) -> Column:
        return F.col(f"{name}_all") - F.col(f"{name}_upto") + F.col(name)

    aggregates, finals = [], []
    for i, m in enumerate(names):
        own = {k: f"_sum_{i}_{k}" for k in RANKED_METRICS[m].per_row}
        point = Tied(
            F.col("value"), F.col("pos"), F.col("neg"), above("pos"), above("neg"), F.col("pos_all"), F.col("neg_all"),
            {k: F.col(c) for k, c in own.items()}, {k: above(c) for k, c in own.items()}, {k: F.col(f"{c}_all") for k, c in own.items()},
        )
        parts = RANKED_METRICS[m].per_score(point)
        aggregates += [c.alias(f"_{i}_{k}") for k, c in parts.items()]
        finals.append(F.when(F.col("_sound"), RANKED_METRICS[m].final({k: F.col(f"_{i}_{k}") for k in parts})).cast("double").alias(m))
    sound = (F.coalesce(F.sum("other"), F.lit(0)) == 0) & (F.count_if(F.col("value").isNull()) == 0)
    return ordered.groupBy(*by).agg(sound.alias("_sound"), *aggregates).select(*by, *finals)


def two_class_log_loss(df: DataFrame, y_true: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """by…, log_loss of the score of the greater label; both labels' losses are summed before it is known which is greater."""
    df = plain_labels(df, y_true)
    label, s = F.when(~missing(df, y_true), col(y_true)), _score(df, score)

    def loss(p: Column) -> Column:
        return F.sum(-F.ln(F.least(F.greatest(p, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))))

    per_label = df.groupBy(*[col(b) for b in by], label.alias("label")).agg(
        F.count("*").alias("n"), loss(s).alias("if_high"), loss(1 - s).alias("if_low"), F.count_if(s.isNull()).alias("bad"),
    )
    first, last = F.min(F.struct("label", "if_low"))["if_low"], F.max(F.struct("label", "if_high"))["if_high"]
    sound = (F.count("*") == 2) & (F.count("label") == 2) & (F.sum("bad") == 0)
    return per_label.groupBy(*by).agg(F.when(sound, (first + last) / F.sum("n")).alias("log_loss"))


def one_vs_rest_auc(
    df: DataFrame, y_true: str, scores: Mapping[object, str], by: Sequence[str] = ()
) -> DataFrame:
    """by…, auc_roc: mean over classes of each class against the rest.

    NULL when a class has no rows, a label has no score column, or the scores of a row
    do not add up to one.
    """
    t = col(y_true)
    total = sum([col(c).cast("double") for c in scores.values()], F.lit(0.0))
    known = F.coalesce(t.isin(list(scores)), F.lit(False))
    classes = F.array(*[
        F.struct(F.lit(str(k)).alias("class"), F.coalesce((t == F.lit(k)).cast("int"), F.lit(0)).alias("is_class"),
                 col(c).cast("double").alias("score"))
        for k, c in scores.items()
    ])
    long = df.select(
        *[col(b) for b in by], (known & (F.abs(total - 1) <= 1.001e-5)).alias("sound"), F.inline(classes)
    )
    per_class = ranked_metrics(
        long.withColumn("score", F.when(F.col("sound"), F.col("score"))), "is_class", "score", [*by, "class"]
    )
    whole = F.count("auc_roc") == len(scores)
    return per_class.groupBy(*by).agg(F.when(whole, F.avg("auc_roc")).alias("auc_roc"))


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def evaluate(
    df: DataFrame,
    metrics: Sequence[str],
    y_true: str,
    y_pred: str | None = None,
    y_proba: Scores | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """by…, seq, metric, value rounded to 6: one row per asked metric and group.

    ``y_proba`` is a score column for the positive class, or class -> score column. Of two
    labels the greater is positive for auc_roc, gini and log_loss; ks_statistic is always
    of label 1 against label 0. A mapping of one class ranks nothing: those are NULL. Boolean labels count as 0 and 1.
    """
    EvalSpec(metrics=tuple(metrics))
    df = plain_labels(df, y_true, y_pred)
    binary = y_proba if isinstance(y_proba, str) or y_proba is None else None
    second = None
    if isinstance(y_proba, Mapping) and len(y_proba) > 1:
        second = list(y_proba.values())[1]
        binary = second if len(y_proba) == 2 else None
    parts = []
    fused = [m for m in metrics if m in _FUSED]
    if "log_loss" in fused and binary is not None and isinstance(y_proba, str):
        fused.remove("log_loss")
        parts.append((two_class_log_loss(df, y_true, y_proba, by), ["log_loss"]))
    if fused:
        parts.append((pointwise_metrics(df, y_true, y_pred, y_proba, fused, by), fused))
    added = [m for m in metrics if m in ADDED_METRICS]
    if added:
        parts.append((
            df.groupBy(*by).agg(*[ADDED_METRICS[m](y_true, y_pred, y_proba).cast("double").alias(m) for m in added]), added
        ))
    table = [m for m in metrics if m in _CONFUSION]
    if table and y_pred is not None:
        parts.append((confusion_metrics(df, y_true, y_pred, by), table))
    ranked = [m for m in metrics if m in _RANKED]
    if ranked and binary is not None:
        parts.append((area_and_gap(labelled_scores(df, y_true, binary, by), by), ranked))
    elif ranked and second is not None:
        auc = one_vs_rest_auc(df, y_true, y_proba, by).withColumn("gini", 2 * F.col("auc_roc") - 1)
        parts.append((auc, [m for m in ranked if m != "ks_statistic"]))
        if "ks_statistic" in ranked:
            gap = area_and_gap(labelled_scores(df, y_true, second, by), by)
            parts.append((gap.select(*by, "ks_statistic"), ["ks_statistic"]))
    own = [m for m in metrics if m in RANKED_METRICS]
    if own and binary is not None:
        parts.append((added_ranked_metrics(df, own, y_true, y_pred, binary, by), own))
    covered = {m for _, names in parts for m in names}
    rest = [m for m in metrics if m not in covered]
    if rest:
        parts.append((pointwise_metrics(df, y_true, None, None, rest, by), rest))
    place = {m: i + 1 for i, m in enumerate(metrics)}
    long = None
    for wide, names in parts:
        rows = wide.select(*by, F.inline(F.array(*[
            F.struct(F.lit(place[m]).alias("seq"), F.lit(m).alias("metric"), F.round(F.col(m), 6).alias("value"))
            for m in names
        ])))
        long = rows if long is None else long.unionByName(rows)
    if long is None:
        schema = "seq int, metric string, value double"
        return df.sparkSession.createDataFrame([], schema)
    return long


def threshold_checks(results: DataFrame, thresholds: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """by…, metric, value, threshold, passed, reason: one row per threshold and group.

    Thresholds of metrics that were not computed are there too, and fail.
    """
    limits = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(float(t)).alias("threshold")) for m, t in thresholds.items()
    ])
    # At most thirteen metrics per group come together in the map.
    have = F.map_from_entries(F.collect_list(F.struct("metric", "value")))
    rows = results.groupBy(*by).agg(have.alias("have")).select(*by, "have", F.inline(limits))
    value = F.element_at("have", F.col("metric"))
    value = F.when(~F.isnan(value), value)
    lower = F.col("metric").isin(*lower_is_better())
    met = F.when(lower, value <= F.col("threshold")).otherwise(value >= F.col("threshold"))
    return rows.select(
        *by, "metric", value.alias("value"), "threshold",
        F.coalesce(met, F.lit(False)).alias("passed"),
        F.when(value.isNull(), F.lit(NO_VALUE)).alias("reason"),
    )


def metric_summary(results: DataFrame, thresholds: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """by…, summary: one text line per metric, in the order asked."""
    limit, shown = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, t in thresholds.items():
        limit = F.when(F.col("metric") == name, F.lit(str(t))).otherwise(limit)
        shown = F.when(F.col("metric") == name, F.lit(float(t))).otherwise(shown)
    value = F.col("value")
    met = F.when(F.col("metric").isin(*lower_is_better()), value <= shown).otherwise(value >= shown)
    text = F.coalesce(F.format_string("%.4f", value), F.lit("FAILED"))
    text = F.when(value.isNull(), F.lit("FAILED")).otherwise(text)
    line = F.when(limit.isNull(), F.concat(F.lit("  ℹ️  "), F.col("metric"), F.lit(": "), text)).otherwise(
        F.concat(
            F.lit("  "), F.when(met, F.lit("✅")).otherwise(F.lit("❌")), F.lit(" "), F.col("metric"),
            F.lit(": "), text, F.lit(" (threshold: "), limit, F.lit(")"),
        )
    )
    lines = results.select(*by, "seq", line.alias("line")).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("seq", "line"))).alias("lines")
    )
    return lines.select(*by, F.concat_ws("\n", F.col("lines.line")).alias("summary"))


def compare_versions(
    df: DataFrame,
    versions: Mapping[str, str],
    metrics: Sequence[str],
    y_true: str,
    cut: float = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """by…, metric, production, candidate, delta from two score columns of one scored batch."""
    candidate, production = col(versions["candidate"]), col(versions["production"])
    long = df.select(*[col(b) for b in by], col(y_true), F.inline(F.array(
        F.struct(F.lit("candidate").alias("version"), candidate.alias("score")),
        F.struct(F.lit("production").alias("version"), production.alias("score")),
    ))).withColumn("predicted", (F.col("score") >= cut).cast("int"))
    results = evaluate(long, metrics, y_true, "predicted", "score", [*by, "version"])
    wide = results.groupBy(*by, "metric").pivot("version", ["candidate", "production"]).agg(F.first("value"))
    return wide.withColumn("delta", F.round(F.col("candidate") - F.col("production"), 6))
