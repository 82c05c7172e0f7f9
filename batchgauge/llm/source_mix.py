"""Mixing sources to target weights, by Efraimidis-Spirakis sampling without a sort of a source.

Targets: the sources share all words by weight; no source takes more than `most` times its
size, and what it leaves is shared by weight among the others (the level is found from one
sorted pass over the sources). A source with target t and size s gives floor(t/s) complete
epochs; the rest of its budget is drawn: each document gets the key -ln(u)/w, with u from a
hash of its id and w its quality weight, and documents are taken in key order while they fit.

The order is never made for a whole source. Words are summed in 4,096 ranges of the key
(rising map to [0, 1)), which decides all ranges but the one where the budget ends; the same
again inside it; only what is left, one 16-millionth of a source, is ranked. A source with a
third of all documents is summed by all tasks.

Defined results: null text has size 0. Null sources are one source, last in order. Rows that
repeat a doc_id draw the same key and come in the order of their sizes. An empty table gives
no rows. The drawn document at the budget's end is taken when that comes nearer to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from batchgauge.llm.common import small, stored

WORDS = r"[^\x20\x09-\x0D]+"
MOST = 3
BINS = 4096


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def quality_weight(text: str = "text") -> Column:
    """1 for plain prose, falling to 0.1 with the share of symbols in a text."""
    symbols = F.length(F.col(text)) - F.length(F.translate(F.col(text), "#*$%&|<>", ""))
    share = symbols / F.greatest(F.length(F.col(text)), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(4.0) * share), F.lit(0.1))


def hashed_unit(key: str = "doc_id") -> Column:
    """A number in (0, 1) from the MD5 of the id, the same everywhere."""
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """From (source, source_size): the target of each source. Weights 1, 2, 3 repeat by code point, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sizes.withColumn("weight", (rank - 1) % 3 + 1).withColumn(
        "limit_at", F.lit(most) * F.col("source_size") / F.col("weight")
    )
    rising = Window.orderBy("limit_at", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = weighed.withColumn("level", (F.sum("source_size").over(everything) - before) / after)
    level = level.withColumn("level", F.min(F.when(F.col("level") <= F.col("limit_at"), F.struct("limit_at", "level"))).over(everything)["level"])
    return level.select(
        "source", "source_size",
        F.least(F.lit(float(most)) * F.col("source_size"), F.col("level") * F.col("weight")).cast("double").alias("target"),
    )


def mixed(docs: DataFrame, most: int = MOST, weight: Column | None = None) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken), one per document."""
    unit = F.lit(1.0) - F.pow(hashed_unit(), F.lit(1.0) / (quality_weight() if weight is None else weight))
    rows = stored(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size"), unit.alias("unit")), "sizes"
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0)
    plan = stored(
        targets(sizes, most).withColumn("epochs", epochs.cast("long"))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "targets",
    )
    plan = small(plan, 128)
    keyed = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        "doc_id", rows["source"], "size", "unit", "source_size", "target", "epochs", "budget"
    )
    # where the budget ends: first among 4,096 ranges of a source, then among 4,096 parts of that range
    rough, fine = F.floor(F.col("unit") * BINS), F.floor(F.col("unit") * BINS * BINS)
    one = stored(_end(keyed.withColumn("bin", rough).withColumn("done", F.lit(0)), "bin"), "ends")
    one = small(one.withColumnsRenamed({"bin": "end1", "before": "before1"}), 64)
    inside = keyed.join(one, keyed["source"].eqNullSafe(one["source"])).drop(one["source"]).filter(rough == F.col("end1"))
    two = stored(_end(inside.withColumn("bin", fine).withColumn("done", F.col("before1")), "bin"), "ends2")
    two = small(two.withColumnsRenamed({"bin": "end2", "before": "before2"}), 64)
    ends = two.join(one, one["source"].eqNullSafe(two["source"])).select(one["source"].alias("_source"), "end1", "end2", "before2")
    placed = keyed.join(F.broadcast(ends) if ends.count() * 64 <= 48_000_000 else ends, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    last = F.col("end2").isNotNull() & (fine == F.col("end2"))
    below = F.coalesce((F.col("budget") > 0) & (F.col("end2").isNull() | (fine < F.col("end2"))), F.lit(False))
    sure = placed.filter(~last | F.col("end2").isNull()).withColumn("drawn", below)
    order = Window.partitionBy("source").orderBy("unit", F.col("doc_id").asc_nulls_last(), "size")
    upto = F.col("before2") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = placed.filter(last).withColumn("upto", upto)
    # take what fits, and the next one if that comes nearer
    nearer = F.col("upto") - F.col("budget") < F.col("budget") - (F.col("upto") - F.col("size"))
    ranked = ranked.withColumn("drawn", (F.col("upto") <= F.col("budget")) | ((F.col("upto") - F.col("size") <= F.col("budget")) & nearer))
    columns = ["doc_id", "size", "source_size", "target", "epochs", "drawn"]
    return sure.select(columns).unionByName(ranked.select(columns)).select(
        "doc_id", "size", "source_size", "target",
        ((F.col("epochs") + F.col("drawn").cast("long")) * F.col("size")).alias("taken"),
    )


def _end(rows: DataFrame, part: str) -> DataFrame:
    """Per source the range in which its budget ends, and the words before that range."""
    sums = rows.groupBy("source", part, "budget", "done").agg(F.sum("size").alias("words"))
    upto = F.col("done") + F.sum("words").over(Window.partitionBy("source").orderBy(part))
    return (
        sums.withColumn("upto", upto).filter(F.col("upto") > F.col("budget"))
        .groupBy("source").agg(F.min(F.struct(part, (F.col("upto") - F.col("words")).alias("before"))).alias("e"))
        .select("source", f"e.{part}", "e.before")
    )
