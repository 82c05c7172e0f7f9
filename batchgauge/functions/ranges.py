"""Ranges of a sort order as even parts of a table, as many as the rows need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchgauge.session import written

ROWS_PER_RANGE = 1_000_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def range_count(rows: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    return max(1, -(-rows // rows_per_range))


def in_ranges(
    stored: DataFrame, order: Sequence[Column], rows_per_range: int = ROWS_PER_RANGE, label: str = "ranges"
) -> DataFrame:
    """A stored table plus ``_range``, the number of its range, and ``_row``, its place in that range.

    Spark samples the order to cut it; the number of ranges follows the number of rows, so a range
    holds about ``rows_per_range`` of them however large the table is. Rows equal in all of
    ``order`` share a range: count such rows first.
    """
    n = range_count(stored.count(), rows_per_range)
    at = F.col("_at")
    dealt = stored.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = written(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    return placed.withColumns({
        "_range": F.shiftright(at, _ROW_BITS), "_row": at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    }).drop("_at")


def running_sums(
    stored: DataFrame, order: Sequence[str], sums: Sequence[str], by: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE, label: str = "ranges",
) -> DataFrame:
    """A stored table plus ``<name>_upto`` and ``<name>_all`` of each column of ``sums``.

    The sums run over the rows of a ``by`` group up to and with a row by ``order``, and over the whole group.
    A table of more rows than ``rows_per_range`` is cut in ranges by (by, order): a range is summed by itself and lifted by what the
    earlier ranges of its groups hold, so a group of any size is spread over many tasks.
    """
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    if stored.count() <= rows_per_range:
        upto = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return stored.withColumns(
            {f"{s}_upto": F.sum(s).over(upto) for s in sums} | {f"{s}_all": F.sum(s).over(whole) for s in sums}
        )
    ranged = in_ranges(stored, [F.asc(c) for c in (*by, *order)], rows_per_range, label)
    parts = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(s) for s in sums])
    # a row per range and group that meets it
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    lifts = written(parts.select(
        *[F.col(b).alias(f"_by_{i}") for i, b in enumerate(by)], F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_below_{s}") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_all") for s in sums],
    ), f"{label}-lifts")
    here = Window.partitionBy(*by, "_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({f"_here_{s}": F.sum(s).over(here) for s in sums})
    same = F.col("_range") == F.col("_of")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by_{i}"))
    return summed.join(lifts, same).select(
        *stored.columns, *[(F.col(f"_here_{s}") + F.col(f"_below_{s}")).alias(f"{s}_upto") for s in sums],
        *[f"{s}_all" for s in sums],
    )


def positioned(
    stored: DataFrame, order: Sequence[Column], rows_per_range: int = ROWS_PER_RANGE, label: str = "places"
) -> DataFrame:
    """A stored table plus ``pos``, the zero-based place of each row by ``order``; no task sorts more than a range."""
    ranged = in_ranges(stored, order, rows_per_range, label)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return ranged.join(F.broadcast(starts), F.col("_range") == F.col("_of")).withColumn(
        "pos", F.col("_start") + F.col("_row")
    ).select(*stored.columns, "pos")
