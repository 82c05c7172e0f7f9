"""Gates before and after scoring: as a report, or raising on the first failure.

All value checks of all columns come from one aggregate over the batch, grouped by
date when several days are checked together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from batchgauge.config import CheckSpec, ColumnSpec
from batchgauge.errors import QualityError, ValidationError
from batchgauge.functions.columns import col, missing, outside, per_column, present

_ERRORS = {"ValidationError": ValidationError, "QualityError": QualityError}

# The texts of the gates, with their number formats.
EMPTY_INPUT = "Input DataFrame is empty — no rows returned from data source"
EMPTY_OUTPUT = "Output DataFrame is empty — model returned no predictions"
NULL_TEXT = "Column '%s' has %.1f%% NaN values (threshold: %s%%)"
RANGE_TEXT = "Column '%s' has %d values outside range [%s, %s]"


def absent_columns(df: DataFrame, wanted: Sequence[str], kind: str) -> str | None:
    """What to say when declared columns are not in the batch; no job runs."""
    absent = sorted(set(wanted) - set(df.columns))
    if not absent:
        return None
    label = "Model returned columns" if kind == "output_columns" else "Available columns"
    return f"Missing {kind}: {absent}. {label}: {sorted(df.columns)}"


def check_input(df: DataFrame, columns: ColumnSpec) -> None:
    """Raise ValidationError unless the batch has rows, ids and features."""
    if df.isEmpty():
        raise ValidationError(EMPTY_INPUT)
    for names, kind in ((columns.id_columns, "id_columns"), (columns.feature_columns, "feature_columns")):
        problem = absent_columns(df, names, kind)
        if problem:
            raise ValidationError(problem)


def gate_counts(
    df: DataFrame, columns: ColumnSpec, checks: CheckSpec, by: Sequence[str] = ()
) -> DataFrame:
    """by…, n_rows, and missing_i / outside_i per output and range column: one pass."""
    flags = {f"missing_{i}": missing(df, c) for i, c in enumerate(columns.output_columns) if c in df.columns}
    for i, (name, (low, high)) in enumerate(checks.prediction_range.items()):
        if name in df.columns:
            flags[f"outside_{i}"] = outside(df, name, low, high)
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), *[F.count_if(flag).alias(name) for name, flag in flags.items()]
    )


def _check(seq: int, name: str, column: str | None, passed: Column, value, threshold, message, error: str):
    return F.struct(
        F.lit(seq).alias("seq"),
        F.lit(name).alias("check_name"),
        F.lit(column).cast("string").alias("column"),
        passed.alias("passed"),
        (value if value is not None else F.lit(None)).cast("double").alias("value"),
        F.lit(threshold).cast("double").alias("threshold"),
        F.when(~passed, message).alias("message"),
        F.lit(error).alias("error"),
    )


def output_report(
    df: DataFrame, columns: ColumnSpec, checks: CheckSpec, by: Sequence[str] = ()
) -> DataFrame:
    """One row per check, in the order the gates are enforced.

    ``passed`` is NULL for checks that cannot be evaluated: there are no rows, or the
    column is not there.
    """
    counts = gate_counts(df, columns, checks, by)
    rows = F.col("n_rows")
    some = rows > 0
    problem = absent_columns(df, columns.output_columns, "output_columns")
    out = [
        _check(1, "not_empty", None, some, rows, None, F.lit(EMPTY_OUTPUT), "ValidationError"),
        _check(
            2, "output_columns_present", None, F.when(some, F.lit(problem is None)), None, None,
            F.lit(problem), "ValidationError",
        ),
    ]
    seq = 3
    for i, name in enumerate(columns.output_columns):
        if f"missing_{i}" in counts.columns:
            pct = F.try_divide(F.col(f"missing_{i}") * F.lit(100.0), rows)
            out.append(_check(
                seq, "null_pct", name, F.when(some, pct <= F.lit(float(checks.null_output_max_pct))), pct,
                float(checks.null_output_max_pct),
                F.format_string(NULL_TEXT, F.lit(name), pct, F.lit(str(checks.null_output_max_pct))),
                "QualityError",
            ))
        seq += 1
    for i, (name, (low, high)) in enumerate(checks.prediction_range.items()):
        if f"outside_{i}" in counts.columns:
            n_out = F.col(f"outside_{i}")
            out.append(_check(
                seq, "range", name, F.when(some, n_out == 0), n_out, 0.0,
                F.format_string(RANGE_TEXT, F.lit(name), n_out, F.lit(str(low)), F.lit(str(high))),
                "QualityError",
            ))
        seq += 1
    return counts.select(*[col(b) for b in by], F.inline(F.array(*out)))


def first_failure(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by…, error, message of the first failing check; NULL where all passed."""
    failed = F.when(~F.col("passed"), F.col("seq"))
    return report.groupBy(*by).agg(
        F.min_by("error", failed).alias("error"), F.min_by("message", failed).alias("message")
    )


def enforce(report: DataFrame) -> None:
    """Raise the first failing check of a report, if any."""
    row = first_failure(report).head()
    if row and row["error"]:
        raise _ERRORS[row["error"]](row["message"])


def check_output(df: DataFrame, columns: ColumnSpec, checks: CheckSpec) -> None:
    """Raise ValidationError or QualityError unless the scores may be saved."""
    enforce(output_report(df, columns, checks))


def feature_null_report(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by…, column, null_pct per feature, missing cells over rows."""
    share = {"null_pct": lambda c: F.avg(missing(df, c).cast("int")) * 100}
    return per_column(df, features, share, by)


def output_stats(df: DataFrame, outputs: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by…, column, min, max, mean and null_count per output column."""
    return per_column(df, outputs, {
        "min": lambda c: F.min(present(df, c)),
        "max": lambda c: F.max(present(df, c)),
        "mean": lambda c: F.avg(present(df, c)),
        "null_count": lambda c: F.count_if(missing(df, c)),
    }, by)
