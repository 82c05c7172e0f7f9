"""Population stability index of many columns at once, and what follows from it.

A reference is read into a profile: per column the inner edges of its bins, the rows in each bin, and all
rows. Profiles are small tables that can be stored. A batch is held against profiles by one wide
conditional aggregate: the edges are constants in it, or one row per group of the batch; no cell is a row of its
own and nothing is joined by column name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from batchgauge.config import DriftSpec
from batchgauge.functions.columns import col, is_numeric, present
from batchgauge.functions.quantiles import (
    approx_quantiles, cells_of_quantiles, cut_points, exact_quantiles, exploded, quantiles_in_cells, with_cell,
)
from batchgauge.session import written

# Bins per column, and what is added to every share.
BINS = 10
EPSILON = 1e-4

#: Columns of one wide aggregate; more are read in several passes, each of its own columns only.
COLUMNS_A_PASS = 60
#: A profile per group of the batch goes to every task up to this many (group, column) pairs.
BROADCAST_PROFILES = 100_000


class Profile(NamedTuple):
    """Distinct inner edges, rows in each of the bins they make, and rows in all."""

    edges: tuple[float, ...]
    counts: tuple[int, ...]
    n: int


EMPTY = Profile((), (0,), 0)
PROFILE = "column string, edges array<double>, ref array<long>, ref_n long"


def comparable_columns(current: DataFrame, reference: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns on both sides that are numeric in the current batch."""
    return [
        c for c in columns
        if c in current.columns and c in reference.columns and is_numeric(current, c)
    ]


def _probs(bins: int) -> list[float]:
    return [i / bins for i in range(1, bins)]


def _with_bins(found: DataFrame) -> DataFrame:
    """Rows of quantiles and the values below each, as profile columns: the bins' counts follow from the ranks."""
    points = F.array_distinct(F.arrays_zip("quantiles", "below"))
    ends = F.concat(F.transform(points, lambda p: p["below"]), F.array(F.col("n")))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(points, lambda p: p["below"]))
    return found.withColumns({
        "edges": F.transform(points, lambda p: p["quantiles"]),
        "ref": F.zip_with(ends, starts, lambda end, start: end - start), "ref_n": F.col("n"),
    }).drop("quantiles", "below", "n")


def reference_profile(
    reference: DataFrame, columns: Sequence[str], bins: int = BINS, approximate: bool = False
) -> dict[str, Profile]:
    """The profile of each column that has values; collected are about 2 x bins numbers per column.

    With exact deciles the reference is read three times, ``approximate`` takes a sketch and a count.
    """
    if not approximate:
        rows = _with_bins(exact_quantiles(reference, columns, _probs(bins))).collect()
        return {r["column"]: Profile(tuple(r["edges"]), tuple(r["ref"]), r["ref_n"]) for r in rows}
    found = approx_quantiles(reference, columns, _probs(bins)).collect()
    edges = {r["column"]: sorted(set(r["quantiles"])) for r in found}
    counted = _wide_counts(reference, list(edges), lambda c: [F.lit(e) for e in edges[c]], ()) if edges else []
    out = {}
    for part, names in counted:
        row = part.first()
        out |= {c: Profile(tuple(edges[c]), tuple(row[f"_{i}"]), sum(row[f"_{i}"])) for i, c in enumerate(names)}
    return out


def profile_rows(spark: SparkSession, profiles: Mapping[str, Profile]) -> DataFrame:
    """Profiles as a table (column, edges, ref, ref_n) that can be stored."""
    rows = [(c, list(p.edges), list(p.counts), p.n) for c, p in profiles.items()]
    return spark.createDataFrame(rows, PROFILE)


def profiles_of(rows: DataFrame) -> dict[str, Profile]:
    """A stored table of profiles, a row per column, for use as constants."""
    return {r["column"]: Profile(tuple(r["edges"]), tuple(r["ref"]), r["ref_n"]) for r in rows.collect()}


def _wide_counts(
    df: DataFrame, columns: Sequence[str], edges: Callable[[str], Sequence[Column]], by: Sequence[str],
    keep: Sequence[Column] = (),
) -> list[tuple[DataFrame, list[str]]]:
    """by…, keep…, `_0`, `_1`, …: rows per bin of each column, and the columns' names; a table per COLUMNS_A_PASS columns.

    One aggregate that combines before its shuffle: what is shuffled is a row per group and task.
    """
    out = []
    for at in range(0, len(columns), COLUMNS_A_PASS):
        names = list(columns[at : at + COLUMNS_A_PASS])
        sums, arrays = [], []
        for i, c in enumerate(names):
            value, cuts = present(df, c), edges(c)
            sums.append(F.count(value).alias(f"_{i}_all"))
            sums += [F.count_if(value >= e).alias(f"_{i}_{k}") for k, e in enumerate(cuts)]
            passed = [F.col(f"_{i}_all"), *[F.col(f"_{i}_{k}") for k in range(len(cuts))], F.lit(0).cast("long")]
            arrays.append(F.array(*[a - b for a, b in zip(passed, passed[1:])]).alias(f"_{i}"))
        kept = [F.first(k).alias(f"_keep_{i}") for i, k in enumerate(keep)]
        wide = df.groupBy(*[col(b) for b in by]).agg(F.count("*").alias("_n"), *sums, *kept)
        out.append((wide.select(*[col(b) for b in by], *arrays, *[f"_keep_{i}" for i in range(len(keep))]), names))
    return out


def _psi(cur: Column, ref: Column, ref_n: Column, eps: float) -> Column:
    """Sum over the bins that the distinct inner edges make; empty bins count on both sides."""
    cur_n = F.aggregate(cur, F.lit(0).cast("long"), lambda acc, n: acc + n)

    def term(r_count: Column, c_count: Column) -> Column:
        r, c = r_count / ref_n + F.lit(eps), c_count / cur_n + F.lit(eps)
        return (c - r) * F.ln(c / r)

    terms = F.zip_with(ref, F.slice(cur, 1, F.size(ref)), term)
    total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return F.when((ref_n > 0) & (cur_n > 0), total).otherwise(F.lit(0.0))


def _long_psi(
    parts: list[tuple[DataFrame, list[str]]], by: Sequence[str], ref: Callable[[str], tuple[Column, Column]]
) -> DataFrame:
    """by…, column, psi from wide counts."""
    long = None
    for wide, names in parts:
        cells = F.array(*[
            F.struct(F.lit(c).alias("column"), _psi(F.col(f"_{i}"), *ref(c), EPSILON).alias("psi"))
            for i, c in enumerate(names)
        ])
        rows = wide.select(*[col(b) for b in by], F.inline(cells))
        long = rows if long is None else long.unionByName(rows)
    return long


def psi_against(profiles: Mapping[str, Profile], current: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by…, column, psi of a batch against profiles: one read of the batch, the edges being constants."""
    known = {c: profiles.get(c, EMPTY) for c in columns}
    parts = _wide_counts(current, list(columns), lambda c: [F.lit(float(e)) for e in known[c].edges], by)
    return _long_psi(parts, by, lambda c: (
        F.array(*[F.lit(n).cast("long") for n in known[c].counts]), F.lit(known[c].n).cast("long")
    ))


def psi_by_group(profiles: DataFrame, current: DataFrame, columns: Sequence[str], by: Sequence[str], on: Sequence[str]) -> DataFrame:
    """by…, column, psi against profiles (on…, column, edges, ref, ref_n), one set for each group of ``on`` (part of ``by``).

    The profiles of a group are one row, joined to the batch by group.
    """
    entry = F.struct("column", F.struct("edges", "ref", "ref_n"))
    table = written(profiles.groupBy(*on).agg(F.map_from_entries(F.collect_list(entry)).alias("_p")), "profiles")
    table = table.withColumnsRenamed({b: f"_on_{i}" for i, b in enumerate(on)})
    if table.count() * len(columns) <= BROADCAST_PROFILES:
        table = F.broadcast(table)
    same = F.lit(True)
    for i, b in enumerate(on):
        same = same & col(b).eqNullSafe(F.col(f"_on_{i}"))
    rows = current.join(table, same, "left")
    parts = _wide_counts(
        rows, list(columns),
        lambda c: [F.get(F.element_at("_p", F.lit(c))["edges"], F.lit(k)) for k in range(BINS - 1)], by, [F.col("_p")],
    )
    zero = F.lit(0).cast("long")
    return _long_psi(parts, by, lambda c: (
        F.coalesce(F.element_at("_keep_0", F.lit(c))["ref"], F.array(zero)), F.coalesce(F.element_at("_keep_0", F.lit(c))["ref_n"], zero)
    ))


def psi(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    by_groups: int = 1,
    bins: int = BINS,
    approximate: bool = False,
) -> DataFrame:
    """by…, column, psi (unrounded) for every column; 0.0 where either side has no values.

    ``by`` columns split the current batch, and the reference too where it has them;
    ``by_groups`` is their known number. Bins come from exact reference deciles, or
    from a one-pass sketch with ``approximate`` (a reference without groups). The current batch is read once.
    """
    columns = list(columns)
    on = [b for b in by if b in reference.columns]
    if not on:
        return psi_against(reference_profile(reference, columns, bins, approximate), current, columns, by)
    found = _with_bins(exact_quantiles(reference, columns, _probs(bins), on, by_groups))
    return psi_by_group(found, current, columns, by, on)


def severity(value: Column, warn: float = 0.10, critical: float = 0.25) -> Column:
    """Tier of an unrounded PSI; both bounds belong to the higher tier."""
    return F.when(value >= critical, "critical").when(value >= warn, "warn").otherwise("none")


def graded(psi_rows: DataFrame, spec: DriftSpec) -> DataFrame:
    """psi rows with severity and message, PSI rounded to 4 after grading."""
    tier = severity(F.col("psi"), spec.psi_warn, spec.psi_critical)
    text = F.format_string("PSI=%.4f (%s)", F.col("psi"), tier)
    return psi_rows.withColumns({"severity": tier, "message": text}).withColumn("psi", F.round("psi", 4))


def drift_check(
    current: DataFrame,
    reference: DataFrame,
    columns: Sequence[str],
    spec: DriftSpec,
    by: Sequence[str] = (),
    by_groups: int = 1,
    approximate: bool = False,
) -> DataFrame:
    """by…, column, psi, severity, message; no rows when drift checks are off."""
    names = comparable_columns(current, reference, columns) if spec.enabled else []
    if not names:
        return _no_drift(current, by)
    return graded(psi(reference, current, names, by, by_groups, approximate=approximate), spec)


def reference_window(df: DataFrame, run_date: str | date, days: int = 30, day: str = "run_date") -> DataFrame:
    """Rows of the ``days`` days before run_date; prunes partitions of a dated table."""
    end = date.fromisoformat(str(run_date))
    return df.filter(col(day).between(F.lit(end - timedelta(days=days)), F.lit(end - timedelta(days=1))))


def rolling_profiles(
    df: DataFrame, columns: Sequence[str], run_dates: Sequence[date], days: int, bins: int = BINS
) -> DataFrame:
    """run_date, column, edges, ref, ref_n: the profile of the ``days`` days before each asked date.

    Daily counts per cell between cut points are written once; the counts of a window are sums of
    days. Only values in cells that hold a wanted rank of some window are read again, counted per day as
    well. So every row is read three times however many dates are asked, and is never repeated for them;
    only counts are.
    """
    wide = df.filter(F.col("run_date").between(
        F.lit(min(run_dates) - timedelta(days=days)), F.lit(max(run_dates) - timedelta(days=1))
    ))
    cuts = cut_points(wide, columns)
    values = exploded(wide, columns, ["run_date"]).filter(F.col("value").isNotNull())
    placed = with_cell(values, [cuts.get(c, []) for c in columns], F.col("idx"))
    keys, asked = ["target", "idx"], _probs(bins)
    windows = F.filter(
        F.array(*[F.lit(d) for d in run_dates]),
        lambda d: F.col("run_date").between(F.date_sub(d, days), F.date_sub(d, 1)),
    )

    daily = written(placed.groupBy("run_date", "idx", "cell").agg(F.count("*").alias("n")), "daily-cells")
    sums = daily.withColumn("target", F.explode(windows)).groupBy(*keys, "cell").agg(F.sum("n").alias("n"))
    wanted = written(cells_of_quantiles(sums, asked, keys), "wanted-cells")
    fullest = wanted.agg(F.coalesce(F.max("held"), F.lit(0))).first()[0]
    wanted = wanted.drop("held")
    cells = wanted.select("idx", "cell").distinct()
    if cells.count() <= BROADCAST_PROFILES:
        cells = F.broadcast(cells)
    seen = written(
        placed.join(cells, ["idx", "cell"], "left_semi").groupBy("run_date", "idx", "cell", "value").agg(F.count("*").alias("n")),
        "daily-values",
    )
    # values of a window: the days' counts of equal values add up
    counted = (
        seen.withColumn("target", F.explode(windows)).groupBy(*keys, "cell", "value").agg(F.sum("n").alias("n"))
        .join(wanted, [*keys, "cell"])
    )
    return _with_bins(quantiles_in_cells(counted, asked, keys, columns, fullest)).withColumnRenamed("target", "run_date")


def rolling_drift(
    df: DataFrame,
    columns: Sequence[str],
    run_dates: Sequence[str | date],
    spec: DriftSpec,
) -> DataFrame:
    """run_date, column, psi, severity, message for each asked date against its own window."""
    asked = [date.fromisoformat(str(d)) for d in run_dates]
    names = comparable_columns(df, df, [c for c in columns if c != "run_date"]) if spec.enabled and asked else []
    if not names:
        return _no_drift(df, ["run_date"])
    profiles = rolling_profiles(df, names, asked, spec.reference_days)
    current = df.filter(F.col("run_date").isin(asked)).select("run_date", *[col(c) for c in names])
    return graded(psi_by_group(profiles, current, names, ["run_date"], ["run_date"]), spec)


def _no_drift(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A drift table without rows."""
    keys = [df.schema[b] for b in by]
    empty = df.sparkSession.createDataFrame([], "column string, psi double, severity string, message string")
    return empty.select(*[F.lit(None).cast(k.dataType).alias(k.name) for k in keys], *empty.columns)


def sustained_drift(drift: DataFrame, at_least: int = 3, of_last: int = 5) -> DataFrame:
    """Drift rows (project_id, column, run_date, severity) plus drifted_days and sustained."""
    recent = Window.partitionBy("project_id", "column").orderBy("run_date").rowsBetween(1 - of_last, 0)
    flag = (F.col("severity") != "none").cast("int")
    return drift.withColumn("drifted_days", F.sum(flag).over(recent)).withColumn(
        "sustained", F.col("drifted_days") >= at_least
    )
