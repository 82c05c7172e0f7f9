"""Fixed-size samples and stratified splits by a hash of the key.

The n smallest hashes are found by descending through the digits of the hash: rows are counted by the next
digits inside the prefix where the sample ends, and everything before that prefix is taken by a
filter, until few enough rows share the prefix to be ranked. Nothing is sorted as a whole, and a retry draws
the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchgauge.functions.columns import col, hash_hex

_DIGITS = 3  # hex digits a step: 4,096 prefixes per stratum are counted at a time
_HASH_DIGITS = 32
_CHUNK = 100_000
_BROADCAST_STRATA = 10_000
#: Distinct rows of one stratum that one task may rank.
ROWS_RANKED = 100_000


def _edges(marked: DataFrame, wanted: Column, rows_ranked: int) -> DataFrame:
    """Per stratum the shortest prefix, in steps of _DIGITS, that holds its last wanted row and few rows, and how many of them are wanted.

    Each step counts the hashes only, and after the first only those below the edge of the last.
    """
    spark, width = marked.sparkSession, _DIGITS
    whole = Window.partitionBy("_stratum")
    below = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    hashes = marked.select("_stratum", "_hash")
    counts = hashes.groupBy("_stratum", F.substring("_hash", 1, width).alias("_prefix")).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_total", F.sum("_n").over(whole)).withColumn("_left", wanted.cast("long"))
    done = None
    while True:
        edge = (
            counts.withColumn("_below", F.coalesce(F.sum("_n").over(below), F.lit(0)))
            .filter((F.col("_below") < F.col("_left")) & (F.col("_left") <= F.col("_below") + F.col("_n")))
            # One row per stratum: the prefix that holds the last wanted row.
            .select("_stratum", F.col("_prefix").alias("_edge"), (F.col("_left") - F.col("_below")).alias("_need"), "_n")
        )
        # Collected: one row per stratum, and no more than fit the check of the broadcast.
        found = edge.limit(_BROADCAST_STRATA + 1).collect()
        if len(found) > _BROADCAST_STRATA:
            # Too many strata to hold, so none of them is large as a share: their edges stay a table.
            return edge.drop("_n") if done is None else done.unionByName(edge.drop("_n"))
        fits = [r for r in found if r["_n"] <= rows_ranked or width >= _HASH_DIGITS]
        part = spark.createDataFrame([tuple(r)[:3] for r in fits], "_stratum string, _edge string, _need long")
        done = part if done is None else done.unionByName(part)
        rest = [tuple(r)[:3] for r in found if not (r["_n"] <= rows_ranked or width >= _HASH_DIGITS)]
        if not rest:
            return F.broadcast(done)
        width += _DIGITS
        inside = F.broadcast(spark.createDataFrame(rest, "_stratum string, _edge string, _left long"))
        counts = (
            hashes.join(inside, "_stratum").filter(F.startswith("_hash", "_edge"))
            .groupBy("_stratum", "_left", F.substring("_hash", 1, width).alias("_prefix")).agg(F.count("*").alias("_n"))
        )


def _first_by_hash(
    df: DataFrame, keys: Sequence[str], seed: int, strata: Sequence[str], wanted: Column, rows_ranked: int = ROWS_RANKED
) -> DataFrame:
    """df plus ``_chosen``: true for the first ``wanted`` rows of each stratum by (hash, row).

    ``wanted`` is an expression over ``_total``, the rows of the stratum. ``keys``
    identify a row; full copies may be there in any number. Strata are the few values
    of a label; NULL is one of them.
    """
    names = [col(c) for c in df.columns]
    marked = df.withColumns({
        "_hash": hash_hex([col(k) for k in keys], seed),
        "_stratum": F.to_json(F.struct(*[col(s) for s in strata])) if strata else F.lit(""),
    })
    placed = marked.join(_edges(marked, wanted, rows_ranked), "_stratum", "left")
    at_edge = F.coalesce(F.startswith("_hash", "_edge"), F.lit(False))
    # Digits sort as the text does, so a hash before its stratum's edge is less than it.
    inner = F.coalesce(F.col("_hash") < F.col("_edge"), F.lit(False))
    decided = placed.filter(~at_edge).select(*names, inner.alias("_chosen"))

    # Copies of a row are one row with a count while the boundary is ranked.
    order = Window.partitionBy("_stratum").orderBy("_hash", *names)
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    take = F.greatest(F.least(F.col("_need") - before, F.col("_n")), F.lit(0))
    counted = (
        placed.filter(at_edge).groupBy("_stratum", "_hash", "_need", *names).agg(F.count("*").alias("_n"))
        .withColumn("_take", take)
    )
    shares = F.array(
        F.struct(F.lit(True).alias("_chosen"), F.col("_take").alias("_copies")),
        F.struct(F.lit(False).alias("_chosen"), (F.col("_n") - F.col("_take")).alias("_copies")),
    )
    chunks = counted.select(*names, F.inline(shares)).filter(F.col("_copies") > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {_CHUNK}")))
    )
    size = F.least(F.lit(_CHUNK), F.col("_copies") - F.col("_chunk") * _CHUNK).cast("int")
    ranked = chunks.repartition("_chunk", *[col(k) for k in keys]).select(
        *names, F.explode(F.array_repeat("_chosen", size)).alias("_chosen")
    )
    return decided.unionByName(ranked)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42, rows_ranked: int = ROWS_RANKED) -> DataFrame:
    """Exactly ``n`` rows by hash of the key, or all rows when there are no more than n."""
    chosen = _first_by_hash(df, keys, seed, [], F.least(F.lit(n), F.col("_total")), rows_ranked)
    return chosen.filter("_chosen").drop("_chosen")


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], test_share: float = 0.2, seed: int = 42, rows_ranked: int = ROWS_RANKED
) -> DataFrame:
    """df plus ``split``: 'test' for the rounded share of every label, else 'train'."""
    wanted = F.round(F.col("_total") * F.lit(float(test_share)), 0)
    chosen = _first_by_hash(df, keys, seed, [label], wanted, rows_ranked)
    return chosen.withColumn("split", F.when(F.col("_chosen"), "test").otherwise("train")).drop("_chosen")
