"""Exact order statistics without sorting, or shuffling, a whole column.

``percentile`` keeps every distinct value of a group in one task. Here a sketch
gives cut points per column, a counting pass finds the few cells between cuts that
hold a wanted rank, and only the values in those cells are grouped and ranked. The
cuts decide how evenly work is spread, never what comes out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchgauge.functions.columns import col, per_column, present
from batchgauge.functions.ranges import ROWS_PER_RANGE, running_sums
from batchgauge.session import written

_MERGE_GROUPS = 64
_BROADCAST_ROWS = 100_000


def default_cells(df: DataFrame) -> int:
    """Cells per column: follows the cluster's shuffle width."""
    return min(4096, max(256, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def double_array(values: Sequence[float]) -> Column:
    """A constant array<double> as one literal, however long."""
    if not values:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def cut_points(df: DataFrame, columns: Sequence[str], cells: int | None = None) -> dict[str, list[float]]:
    """Approximate inner quantiles of numeric columns; a column without values is left out.

    Task sketches meet in 64 reducers first, so that no task merges one sketch per
    input split. Collected: columns x cells numbers, which fixes the cuts for every
    later pass over the data.
    """
    cells = cells or default_cells(df)
    grid = double_array([i / cells for i in range(1, cells)])
    part = F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("_part")
    values = df.select(*[present(df, c).alias(c) for c in columns], part)
    parts = per_column(
        values, columns, {"cuts": lambda c: F.percentile_approx(col(c), grid, F.lit(2 * cells))}, ["_part"]
    )
    merged = (
        parts.select("column", F.explode("cuts").alias("cut"))
        .groupBy("column")
        .agg(F.percentile_approx("cut", grid, F.lit(2 * cells)).alias("cuts"))
    )
    return {row["column"]: sorted(set(row["cuts"])) for row in merged.collect()}


def exploded(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by…, idx, value: one row per cell, ``idx`` being the place of its column."""
    values = F.array(*[present(df, c) for c in columns])
    return df.select(*[col(b) for b in by], F.posexplode(values).alias("idx", "value"))


def with_cell(df: DataFrame, cuts: Sequence[Sequence[float]], idx: Column) -> DataFrame:
    """df plus ``cell``: how many of the ascending cuts of column ``idx`` are <= ``value``.

    A binary search, one projection per halving: all of it stays in generated code, where
    a lambda, or a join that brings the cuts to each row, would not.
    """
    arrays = F.get(F.array(*[double_array(c) for c in cuts]), idx)
    df = df.withColumn("cell", F.lit(0))
    at = F.col("cell")
    longest = max((len(c) for c in cuts), default=0)
    for step in (1 << i for i in reversed(range(longest.bit_length()))):
        ahead = F.get(arrays, at + (step - 1)) <= F.col("value")
        df = df.withColumn("cell", F.when(ahead, at + step).otherwise(at))
    return df


def _wanted_ranks(probs: Column, total: Column) -> Column:
    """The zero-based ranks on both sides of each quantile of ``total`` values."""
    below = F.transform(probs, lambda p: F.floor(p * (total - 1)).cast("long"))
    return F.array_distinct(F.concat(below, F.transform(below, lambda r: F.least(r + 1, total - 1))))


def _within(ranks: Column, start: Column, count: Column) -> Column:
    return F.filter(ranks, lambda r: (r >= start) & (r < start + count))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    by_groups: int = 1,
    cells: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """by…, column, n, quantiles, below of numeric columns; missing values aside.

    Quantiles are linearly interpolated; ``below`` counts the values smaller than each.
    The cells that hold a wanted rank are broadcast while there are fewer than 100,000. The data are read
    three times and shuffled never, but for the values in those cells; a cell of more than
    ``rows_per_range`` values is cut again, in as many ranges as it needs. ``by_groups`` is not needed any more.
    """
    columns = list(columns)
    found = cut_points(df, columns, cells)
    keys = [*by, "idx"]
    values = exploded(df, columns, by).filter(F.col("value").isNotNull())
    placed = with_cell(values, [found.get(c, []) for c in columns], F.col("idx"))
    wanted = written(cells_of_quantiles(placed.groupBy(*keys, "cell").agg(F.count("*").alias("n")), probs, keys), "wanted-cells")
    # Collected: how many cells are wanted, and the values in the fullest.
    many, fullest = wanted.agg(F.count("*"), F.coalesce(F.max("held"), F.lit(0))).first()
    wanted = wanted.drop("held")
    counted = (
        placed.join(F.broadcast(wanted) if many <= _BROADCAST_ROWS else wanted, [*keys, "cell"])
        .groupBy(*keys, "cell", "value", "total", "before").agg(F.count("*").alias("n"))
    )
    return quantiles_in_cells(counted, probs, keys, columns, fullest, rows_per_range)


def cells_of_quantiles(counts: DataFrame, probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """From (keys…, cell, n): the cells that hold a wanted rank, with the values in all cells, in those below, and ``held`` in them."""
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    asked = double_array(probs)
    return (
        counts.select(
            *keys, "cell", "n",
            F.sum("n").over(group).alias("total"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        )
        .filter(F.size(_within(_wanted_ranks(asked, F.col("total")), F.col("before"), F.col("n"))) > 0)
        .withColumnRenamed("n", "held")
    )


def quantiles_in_cells(
    counted: DataFrame, probs: Sequence[float], keys: Sequence[str], columns: Sequence[str], fullest: int,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """From (keys…, cell, value, total, before, n) of the wanted cells: keys but idx…, column, n, quantiles, below.

    ``fullest`` bounds the values in a cell: up to ``rows_per_range`` a cell is ranked by one task.
    """
    asked = double_array(probs)
    if fullest <= rows_per_range:
        in_cell = Window.partitionBy(*keys, "cell").orderBy("value")
        start = F.col("before") + F.coalesce(
            F.sum("n").over(in_cell.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
    else:
        counted = running_sums(written(counted, "cell-values"), ["value"], ["n"], [*keys, "cell"], rows_per_range, "cell-ranges")
        start = F.col("before") + F.col("n_upto") - F.col("n")
    picked = (
        counted.withColumn("start", start)
        .withColumn("ranks", _within(_wanted_ranks(asked, F.col("total")), F.col("start"), F.col("n")))
        .filter(F.size("ranks") > 0)
        .select(*keys, "total", F.explode("ranks").alias("rank"), F.struct("value", "start").alias("found"))
    )
    # At most two values per asked quantile come together here.
    ranked = picked.groupBy(*keys).agg(
        F.max("total").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("rank", "found"))).alias("at"),
    )
    at, n = F.col("at"), F.col("n")
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.col("idx"))
    by = [k for k in keys if k != "idx"]
    points = ranked.select(
        *[col(b) for b in by], name.alias("column"), "n",
        F.transform(asked, lambda p: _interpolate(at, n, p)).alias("points"),
    )
    return points.select(
        *[col(b) for b in by], "column", "n",
        F.col("points.value").alias("quantiles"), F.col("points.below").alias("below"),
    )


def _interpolate(at: Column, n: Column, p: Column) -> Column:
    """The quantile between two neighbouring values, and how many values lie below it."""
    place = p * (n - 1)
    rank = F.floor(place).cast("long")
    low, high = F.element_at(at, rank), F.element_at(at, F.least(rank + 1, n - 1))
    share, gap = place - rank, high["value"] - low["value"]
    # From the nearer end, which keeps the result between low and high.
    value = F.when(share < 0.5, low["value"] + gap * share).otherwise(high["value"] - gap * (1 - share))
    below = F.when(value <= low["value"], low["start"]).otherwise(high["start"])
    return F.struct(value.alias("value"), below.alias("below"))


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """The one-pass sketch version of ``exact_quantiles``; rank error at most 0.01 %."""
    asked = F.array(*[F.lit(float(p)) for p in probs])
    found = per_column(df, columns, {
        "n": lambda c: F.count(present(df, c)),
        "quantiles": lambda c: F.percentile_approx(present(df, c), asked, F.lit(10_000)),
    }, by)
    return found.filter(F.col("n") > 0)
