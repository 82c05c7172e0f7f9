"""Places of rows in a global order, without a sort of a whole table or group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchgauge.llm.common import small, stored

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def positioned(rows: DataFrame, order: list[Column], within: str | None = None, label: str = "ranks") -> DataFrame:
    """`rows` with `pos`: the zero-based place of each row by `order`, counted apart for each value of `within`.

    `order` starts with `within`, where there is one. Rows are dealt out by ranges of the order and sorted
    inside each; what the earlier ranges hold is added from one count per range. A hot value of
    `within` is spread over many ranges. Rows that are equal in all of `order` get neighbouring
    places in any order. `rows` should be a stored table: its ranges are sampled first.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    at = F.col("_at")
    placed = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    placed = placed.withColumns({"_part": F.shiftright(at, _ROW_BITS), "_row": at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}).drop("_at")
    keys = [] if within is None else [within]
    firsts = placed.groupBy(*keys, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    # a row per range here, however many rows there are
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = firsts.select(
        *[F.col(k).alias("_within") for k in keys], F.col("_part").alias("_range"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    starts = small(stored(starts, f"{label}-starts"), 128)
    same = F.col("_part") == F.col("_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_within"))
    return placed.join(starts, same).withColumn("pos", F.col("_row") + F.col("_shift")).select(*rows.columns, "pos")
