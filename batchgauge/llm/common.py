"""Helpers that several operators share: scratch tables, checked broadcasts, samples, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from batchgauge.session import scratch_folder

BROADCAST_BYTES = 48_000_000
TEXT_ROWS = 2000
MAX_ROUNDS = 60


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS):
    """While an action runs, whole texts go to Python `rows` at a time: two tasks then fit a small executor."""
    return _set(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def released(spark: SparkSession):
    """The shuffle files of an action go when it ends, not when the driver happens to collect its garbage."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def stored(df: DataFrame, label: str, texts: bool = False) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: the lineage and its shuffle files end there.

    texts: the plan hands whole texts to Python.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    with released(spark), text_batches(spark) if texts else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of `stored` tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored table for broadcast when its counted size is below the limit; else leave it to a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def apart(df: DataFrame, reserved: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """df with those columns renamed that are called like an operator's own (in any case), and the way back."""
    taken, own, back = {c.lower() for c in df.columns}, {n.lower() for n in reserved}, {}
    for name in [c for c in df.columns if c.lower() in own]:
        other = f"{name}_"
        while other.lower() in taken | own:
            other += "_"
        taken.add(other.lower())
        back[other] = name
    return df.withColumnsRenamed({name: other for other, name in back.items()}), back


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str = "doc_id"):
    """True for the fifth of the keys that nothing is learned from. A null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def bounded_sample(df: DataFrame, key: str, stratum: str, per_stratum: int, max_strata: int | None = 1000) -> DataFrame:
    """About `per_stratum` rows of each stratum (never more), the same on every run.

    A count per stratum sets a share of the hash range, so only about twice the bound is
    ranked per stratum whatever the table's size. At most `max_strata` strata, largest first (None: all).
    """
    counts = df.groupBy(stratum).count().orderBy(F.desc("count"), stratum)
    counts = (counts if max_strata is None else counts.limit(max_strata)).collect()
    spark = df.sparkSession
    shares = spark.createDataFrame(
        [(r[0], min(1.0, 2.0 * per_stratum / max(1, r["count"]) + 1e-9)) for r in counts],
        df.select(stratum).schema.add("_share", "double"),
    )
    h = F.xxhash64(F.lit(17), F.col(key))
    unit = (h.bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)
    picked = df.withColumn("_h", h).join(F.broadcast(shares), stratum).filter(unit < F.col("_share"))
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key))
    return picked.withColumn("_rank", rank).filter(F.col("_rank") <= per_stratum).drop("_h", "_share", "_rank")


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of the links (a, b), as rows (v, root): root is the smallest vertex.

    Alternating star contraction: every vertex hands its larger neighbours, then all its
    neighbours, to its smallest one. Only links are shuffled, and each step is stored.
    """
    links = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(),
        f"{label}-links",
    )
    if links.isEmpty():
        return links.select(F.col("u").alias("v"), F.col("v").alias("root"))
    before = None
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        star = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            near.select("u", F.col("m").alias("v"))
        )
        links = stored(star.filter("u <> v").distinct(), f"{label}-links")
        state = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components did not settle")
    roots = links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "v")
    own = links.select(F.col("v")).distinct().join(roots.select("v"), "v", "left_anti")
    return roots.unionByName(own.select("v", F.col("v").alias("root")))
