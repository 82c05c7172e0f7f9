"""Daily profiles of features as counts per cell, kept in a log and added up over days.

A result table keeps no features, so what drift needs of them is written when a day is scored: how many values fell into each
cell of a fixed grid. The cells of a number lie between two powers of two, 128 of equal width, so a cell is at most 0.8 %
of its value wide whatever the data are; counts of any days can be added, and no cut has to be agreed on first. A cell is
named by its lower end. Edges of a window's bins are such ends, so the bins' counts are exact sums of
cells on either side.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchgauge.config import DriftSpec, Project
from batchgauge.functions.columns import col, is_numeric, present
from batchgauge.operators.drift import BINS, EPSILON, _psi, graded

CELL_BITS = 7
#: Numbers nearer to 0 than this count as 0.
LEAST = 1e-300


def cell_of(value: Column, bits: int = CELL_BITS) -> Column:
    """The lower end of the value's cell; the same number in every engine, as only powers of two divide."""
    size = F.least(F.abs(value), F.lit(1.7e308))
    rough = F.floor(F.log2(size))
    two = F.lit(2.0)
    # a logarithm may be off by one at a power of two
    exponent = F.when(F.pow(two, rough) > size, rough - 1).when(F.pow(two, rough + 1) <= size, rough + 1).otherwise(rough)
    width = F.pow(two, exponent - F.lit(bits))
    inside = F.floor(value / width) * width
    return F.when(size < LEAST, F.lit(0.0)).when(F.abs(value) == F.lit(float("inf")), value).when(value.isNotNull(), inside)


def feature_cells(batch: DataFrame, columns: Sequence[str], day: Column | None = None) -> DataFrame:
    """run_date, column, cell, n of the numeric columns; a NULL cell counts missing values. Counts combine before the shuffle."""
    names = [c for c in columns if c in batch.columns and is_numeric(batch, c)]
    if not names:
        return batch.sparkSession.createDataFrame([], "run_date date, column string, cell double, n long")
    rows = batch.select(
        (F.col("run_date") if day is None else day).cast("date").alias("run_date"),
        F.posexplode(F.array(*[present(batch, c) for c in names])).alias("idx", "value"),
    )
    counts = rows.groupBy("run_date", "idx", cell_of(F.col("value")).alias("cell")).agg(F.count("*").alias("n"))
    name = F.get(F.array(*[F.lit(c) for c in names]), F.col("idx"))
    return counts.select("run_date", name.alias("column"), "cell", "n")


def latest_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a log that its last write for each of ``keys`` left: a date that ran again counts once."""
    newest = log.groupBy(*keys).agg(F.max("created_at").alias("_newest"))
    # a row per key, so it goes to every task
    return log.join(F.broadcast(newest), list(keys)).filter(F.col("created_at") == F.col("_newest")).drop("_newest")


def drift_from_log(
    log: DataFrame, project: Project, run_dates: Sequence[date], columns: Sequence[str], spec: DriftSpec
) -> DataFrame:
    """run_date, column, psi, severity, message: each date's cells against those of the days before it.

    The edges are the ends of the cells in which the deciles of the window lie. Only counts are read; a date without a window has no rows.
    """
    first, last = min(run_dates) - timedelta(days=spec.reference_days), max(run_dates)
    cells = log.filter(
        (F.col("project_id") == project.project_id) & F.col("run_date").between(F.lit(first), F.lit(last))
        & F.col("column").isin(list(columns))
    )
    cells = latest_rows(cells, ["run_date"]).filter(F.col("cell").isNotNull()).select("run_date", "column", "cell", "n")
    days = F.filter(
        F.array(*[F.lit(d) for d in run_dates]),
        lambda d: F.col("run_date").between(F.date_sub(d, spec.reference_days), F.date_sub(d, 1)),
    )
    window = cells.withColumn("target", F.explode(days)).groupBy("target", "column", "cell").agg(F.sum("n").alias("ref"))
    own = cells.filter(F.col("run_date").isin(list(run_dates))).select(
        F.col("run_date").alias("target"), "column", "cell", F.col("n").alias("cur")
    )
    both = window.join(own, ["target", "column", "cell"], "full").select(
        "target", "column", "cell", F.coalesce("ref", F.lit(0)).alias("ref"), F.coalesce("cur", F.lit(0)).alias("cur")
    )
    # the cells of one column and date come together: a few thousand at most
    group = Window.partitionBy("target", "column")
    upto, total = F.sum("ref").over(group.orderBy("cell")), F.sum("ref").over(group)
    ranked = both.select("target", "column", "cell", "ref", "cur", upto.alias("upto"), total.alias("total"))
    edges = [
        F.min(F.when(F.col("upto") * BINS >= F.col("total") * i, F.col("cell"))).over(group) for i in range(1, BINS)
    ]
    binned = ranked.filter("total > 0").withColumn("edges", F.array_distinct(F.array(*edges)))
    place = F.size(F.filter("edges", lambda e: e <= F.col("cell")))
    binned = binned.withColumn("bin", place).groupBy("target", "column").agg(
        *[F.sum(F.when(F.col("bin") == b, F.col(side)).otherwise(0)).alias(f"{side}_{b}") for side in ("ref", "cur") for b in range(BINS)],
        F.max(F.size("edges")).alias("m"), F.sum("ref").alias("ref_n"),
    )
    ref, cur = (F.array(*[F.col(f"{side}_{b}") for b in range(BINS)]) for side in ("ref", "cur"))
    value = _psi(cur, F.slice(ref, F.lit(1), F.col("m") + 1), F.col("ref_n"), EPSILON)
    # a column without a value on the date itself has no drift to speak of
    return graded(binned.select(F.col("target").alias("run_date"), "column", value.alias("psi")), spec)


def log_features(store, project: Project, batch: DataFrame, created_at: Column, day: Column | None = None) -> None:
    """Append the cells of a batch's features, one day or many, to the feature log."""
    rows = feature_cells(batch, project.schema.feature_columns, day)
    store.append_log("feature_log", rows.withColumns({"project_id": F.lit(project.project_id), "created_at": created_at}))
