"""History and distribution queries over the platform and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from batchgauge.functions.columns import col, per_column, present
from batchgauge.functions.ranges import ROWS_PER_RANGE, positioned
from batchgauge.session import written

_SMALL_LIMIT = 1_000
#: Keys sampled to bound where a limit ends.
_SAMPLED_KEYS = 100_000
#: Columns of one wide aggregate.
_COLUMNS_A_PASS = 20


def project_list(registry: DataFrame) -> DataFrame:
    return registry.orderBy("project_id")


def run_history(run_log: DataFrame, project_id: str, limit: int = 30) -> DataFrame:
    """Latest runs of one project, newest first."""
    return (
        run_log.filter(F.col("project_id") == project_id)
        .orderBy(F.desc("run_date"), F.desc("created_at")).limit(limit)
    )


def check_history(monitoring_log: DataFrame, project_id: str, limit: int = 100) -> DataFrame:
    """Latest check results of one project: newest date first, then by check name."""
    return (
        monitoring_log.filter(F.col("project_id") == project_id)
        .orderBy(F.desc("run_date"), "check_name", F.desc("created_at")).limit(limit)
    )


def recent_predictions(result: DataFrame, ids: Sequence[str], limit: int = 100) -> DataFrame:
    """Newest rows of a result table; ids break ties."""
    return result.orderBy(F.desc("run_date"), *[col(i) for i in ids]).limit(limit)


def predictions_of(result: DataFrame, run_date, ids: Sequence[str], limit: int = 5) -> DataFrame:
    """The first rows of one date; reads one partition."""
    return result.filter(F.col("run_date") == F.lit(str(run_date)).cast("date")).orderBy(
        *[col(i) for i in ids]
    ).limit(limit)


def latest_run(run_log: DataFrame, by_creation: bool = False) -> DataFrame:
    """The newest run of every project: by date then creation time, or by creation time alone."""
    first = ["created_at"] if by_creation else ["run_date", "created_at"]
    rest = [c for c in run_log.columns if c != "project_id"]
    order = [*first, *[c for c in rest if c not in first]]
    picked = run_log.groupBy("project_id").agg(F.max(F.struct(*order)).alias("row"))
    return picked.select("project_id", *[F.col("row").getField(c).alias(c) for c in rest])


def latest_checks(monitoring_log: DataFrame) -> DataFrame:
    """The check rows of each project's newest date."""
    newest = monitoring_log.groupBy("project_id").agg(F.max("run_date").alias("run_date"))
    return monitoring_log.join(newest, ["project_id", "run_date"])


def check_trend(monitoring_log: DataFrame, project_id: str, check_name: str) -> DataFrame:
    """One check's values in date order."""
    return (
        monitoring_log.filter((F.col("project_id") == project_id) & (F.col("check_name") == check_name))
        .select("run_date", "value", "threshold", "passed").orderBy("run_date")
    )


def check_names(monitoring_log: DataFrame) -> DataFrame:
    return monitoring_log.select("check_name").distinct()


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """column, bin, low, high, n: equal-width right-closed bins; empty bins are kept.

    Two reads: the bounds of every column, then one wide conditional aggregate in which they are constants.
    Collected are two numbers per column.
    """
    bounds = per_column(df, columns, {
        "low": lambda c: F.min(present(df, c)), "high": lambda c: F.max(present(df, c)),
    }).filter(F.col("low").isNotNull()).collect()
    ends = {}
    for r in bounds:
        low, high = r["low"], r["high"]
        # A constant column gets a small range around its value, as a plot would.
        pad = 0.0 if low < high else abs(low) * 0.001 or 0.001
        ends[r["column"]] = (low - pad, high + pad)
    names = [c for c in columns if c in ends]
    out = None
    for at in range(0, len(names), _COLUMNS_A_PASS):
        sums, cells = [], []
        for i, c in enumerate(names[at : at + _COLUMNS_A_PASS]):
            low, high = ends[c]
            width = (high - low) / bins
            place = F.least(F.greatest(F.ceil((present(df, c) - low) / width), F.lit(1)), F.lit(bins))
            place = F.when(present(df, c).isNotNull(), place)  # greatest() alone would fill in missing values
            sums += [F.count_if(place == b).alias(f"_{i}_{b}") for b in range(1, bins + 1)]
            cells += [
                F.struct(F.lit(c).alias("column"), F.lit(b).alias("bin"), F.lit(low + (b - 1) * width).alias("low"),
                         F.lit(low + b * width).alias("high"), F.col(f"_{i}_{b}").alias("n"))
                for b in range(1, bins + 1)
            ]
        rows = df.agg(*sums).select(F.inline(F.array(*cells)))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return df.sparkSession.createDataFrame([], "column string, bin int, low double, high double, n long")
    return out


def top_rows(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), tie).limit(k)


def first_rows(df: DataFrame, n: int, keys: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The first n rows by key: a LIMIT that gives the same rows every time.

    Keys of any types and any number of ties on the first of them. The key at the end of the limit is bounded by a
    sample of the keys; rows beyond the bound are filtered out, a filter on the first key that also reaches the
    scan. What is left is ranked in ranges, so that no task gets n rows; a small limit is a plain top-k. Rows
    equal in all keys are ordered by the other columns.
    """
    order = [*keys, *[c for c in df.columns if c not in keys and not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]]
    order = [col(c).asc_nulls_first() for c in order]
    if n <= _SMALL_LIMIT:
        return df.orderBy(*order).limit(n)
    near = written(_not_beyond(df, n, keys), "first-rows")
    first = positioned(near, order, rows_per_range, "first-places").filter(F.col("pos") < n)
    return first.orderBy("pos").drop("pos")


def _not_beyond(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """All rows that can be among the first n by ``keys``. Collected: counts, and one key."""
    total = df.count()
    share = min(1.0, _SAMPLED_KEYS / max(1, total))
    if total <= 2 * n:
        return df
    key = F.struct(*[col(k) for k in keys])
    drawn = df.select(*[col(k) for k in keys]).sample(share, seed=7)
    place = n * share
    while True:
        # a place well after the expected one; a sample that runs out bounds nothing
        place = 1.1 * place + 100
        # Collected: one key of a sample of bounded size.
        at = drawn.orderBy(*[col(k).asc_nulls_first() for k in keys]).limit(int(place) + 1).tail(1)
        if not at or place >= total * share:
            return df
        bound = F.struct(*[F.lit(at[0][k]).cast(df.schema[k].dataType).alias(k) for k in keys])
        lead = at[0][keys[0]]
        # the first key alone is a test that a scan can use; NULL keys come first in the order
        within = col(keys[0]).isNull() if lead is None else col(keys[0]).isNull() | (col(keys[0]) <= F.lit(lead))
        near = df.filter(within & (key <= bound))
        if near.count() >= n:
            return near
