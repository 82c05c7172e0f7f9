"""Result, run-log and monitoring tables as date- or project-partitioned parquet.

Writes are safe to repeat: a date is either skipped or replaced as a whole, and a
failed job leaves the old partition in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from batchgauge.config import ColumnSpec, Project
from batchgauge.functions.columns import col
from batchgauge.operators.sampling import sample_rows
from batchgauge.sources.readers import read_separated

#: Bound on the filter of stored keys that goes to every task, and the bits a key sets in it.
FILTER_BYTES = 32 << 20
_HASHES = 6

# The columns of the platform tables.
RUN_LOG = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
MONITORING_LOG = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
])
PROJECT_REGISTRY = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("owner", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("last_run_at", T.TimestampType()),
])
# What a monitored run adds to the fixed tables: its drift rows and the alerts to send.
DRIFT_LOG = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("column", T.StringType()),
    T.StructField("psi", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
ALERT_LOG = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("channel", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("n_failed", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
# How many values of a feature fell into each cell on a day; a NULL cell counts the missing ones.
FEATURE_LOG = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("column", T.StringType()),
    T.StructField("cell", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("created_at", T.TimestampType()),
])
PLATFORM_TABLES = ("run_log", "monitoring_log", "project_registry")
_LOG_TABLES = {
    "run_log": (RUN_LOG, ["project_id"]),
    "monitoring_log": (MONITORING_LOG, ["project_id"]),
    "project_registry": (PROJECT_REGISTRY, []),
    "drift_log": (DRIFT_LOG, ["project_id"]),
    "alert_log": (ALERT_LOG, ["project_id"]),
    "feature_log": (FEATURE_LOG, ["project_id"]),
}


def result_schema(columns: ColumnSpec, scored: T.StructType) -> T.StructType:
    """ids, run_date, outputs, created_at, typed as they were scored."""
    return T.StructType([
        *[T.StructField(c, scored[c].dataType) for c in columns.id_columns],
        T.StructField("run_date", T.DateType(), False),
        *[T.StructField(c, scored[c].dataType) for c in columns.output_columns],
        T.StructField("created_at", T.TimestampType()),
    ])


class Store:
    """Tables in one folder; ``results.scores`` lives in ``<root>/results/scores``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def ensure(self, table: str, schema: T.StructType, partition: Sequence[str] = ()) -> None:
        """Create the table if it is not there; what is there stays."""
        try:
            self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("append").partitionBy(*partition).parquet(self.path(table))

    def ensure_platform_tables(self) -> None:
        for table in PLATFORM_TABLES:
            self.ensure(table, *_LOG_TABLES[table])

    def ensure_result_table(self, project: Project, scored: T.StructType) -> T.StructType:
        schema = result_schema(project.schema, scored)
        self.ensure(project.output.target_table, schema, ["run_date"])
        return schema

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        schema = schema or (_LOG_TABLES[table][0] if table in _LOG_TABLES else None)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        df = reader.parquet(self.path(table))
        return df.select(*[col(n) for n in schema.names]) if schema is not None else df

    def result(self, project: Project, scored: T.StructType) -> DataFrame:
        return self.read(project.output.target_table, result_schema(project.schema, scored))

    def append_log(self, table: str, rows: DataFrame) -> None:
        """Append rows of one of the platform tables, in one write."""
        schema, partition = _LOG_TABLES[table]
        rows.select(*[col(n) for n in schema.names]).write.mode("append").partitionBy(*partition).parquet(
            self.path(table)
        )


def with_run_date(df: DataFrame, run_date: str | date) -> DataFrame:
    """Add the date column unless the batch has one."""
    return df if "run_date" in df.columns else df.withColumn("run_date", F.lit(str(run_date)).cast("date"))


def dedup_keys(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, then by all other columns.

    A grouped max, combined before the shuffle, so a key that holds much of the data
    is never sorted in one task.
    """
    order = [c for c in latest_by if c not in keys]
    order += [c for c in df.columns if c not in keys and c not in order]
    if not order:
        return df.distinct()
    kept = df.groupBy(*[col(k) for k in keys]).agg(F.max(F.struct(*[col(c) for c in order])).alias("_row"))
    return kept.select(*[
        col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns
    ])


def unseen_keys(df: DataFrame, stored: DataFrame, keys: Sequence[str], filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Rows whose key is not in the stored table yet.

    The stored keys make a Bloom filter of at most ``filter_bytes``, which goes to every task of the batch: rows it has never seen
    are unseen for sure, and only what it lets pass is joined with the stored keys. ``df`` is read
    twice, once for each part.
    """
    known = stored.select(*[col(k) for k in keys])
    if known.isEmpty():
        return df
    seen = _bloom_test(known, keys, filter_bytes)
    return df.filter(~seen).unionByName(df.filter(seen).join(known.distinct(), list(keys), "left_anti"))


def _positions(keys: Sequence[str], bits: int) -> list[Column]:
    """The bits of a key, from two hashes of it. A key with a NULL is never equal to another, wherever its bits lie."""
    one, two = (F.xxhash64(F.lit(seed), *[col(k) for k in keys]) for seed in (1, 2))
    # remainders first: their sums cannot overflow
    first, step = F.pmod(one, F.lit(bits)), F.pmod(two, F.lit(bits))
    return [F.pmod(first + F.lit(i) * step, F.lit(bits)) for i in range(_HASHES)]


def _bloom_test(known: DataFrame, keys: Sequence[str], filter_bytes: int) -> Column:
    """A test that is true for every key of ``known`` and for few others.

    Collected: the filter's words, at most ``filter_bytes`` of them. About ten bits a key, as long as these fit.
    """
    spark = known.sparkSession
    bits = 64
    while bits < min(10 * known.count(), 8 * filter_bytes):
        bits *= 2
    words = (
        known.select(F.explode(F.array(*_positions(keys, bits))).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set")).toArrow()
    )
    table = np.zeros(bits // 64, np.uint64)
    table[words["word"].to_numpy()] = words["set"].to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def passes(*at: pd.Series) -> pd.Series:
        out = np.ones(len(at[0]), bool)
        for bit in at:
            spot = bit.to_numpy().astype(np.uint64)
            out &= (shared.value[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
        return pd.Series(out)

    return passes(*_positions(keys, bits))


def stored_dates(stored: DataFrame, dates: Sequence[str | date]) -> list[date]:
    """Which of the asked dates have rows; reads only those partitions. Collected: one value per date."""
    days = [date.fromisoformat(str(d)) for d in dates]
    rows = stored.filter(F.col("run_date").isin(days)).select("run_date").distinct().collect()
    return sorted(r["run_date"] for r in rows)


def _write_dates(df: DataFrame, path: str) -> None:
    # Rebalancing gathers each date into files of even size and splits the dates that hold most rows.
    # Dates are staged and moved in whole, so a job that dies leaves no part of one.
    df.hint("rebalance", "run_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_date"
    ).parquet(path)


def _new_keys(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, of its first date in the batch, and none of a key that other dates have stored."""
    fresh = unseen_keys(rows, others, keys)
    # the first date, then the greatest of the other columns
    order = F.struct(F.negative(F.unix_date("run_date")).alias("_first"), *[col(c) for c in rows.columns if c not in keys])
    kept = fresh.groupBy(*[col(k) for k in keys]).agg(F.max(order).alias("_row"))
    return kept.select(*[col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in rows.columns])


def save_dates(
    store: Store, df: DataFrame, project: Project, dates: Sequence[str | date],
    created_at: datetime | Column | None = None,
) -> dict[date, str]:
    """Write the rows of ``dates`` in one job: date -> 'success' or 'skipped'.

    In mode ``replace_date`` the dates are overwritten, a date without rows being
    cleared. In any other mode dates that have rows already are left alone. With a ``dedup_key`` of scope
    ``table``, rows whose key another stored date has are left out.
    """
    days = [date.fromisoformat(str(d)) for d in dates]
    schema = store.ensure_result_table(project, df.schema)
    stored, path = store.read(project.output.target_table, schema), store.path(project.output.target_table)
    present = stored_dates(stored, days)
    replacing = project.output.write_mode == "replace_date"
    write = days if replacing else [d for d in days if d not in present]
    if write:
        stamp = F.current_timestamp() if created_at is None else F.lit(created_at)
        rows = df.filter(F.col("run_date").isin(write)).withColumn("created_at", stamp.cast("timestamp"))
        rows = rows.select(*[col(n) for n in schema.names])
        keys = list(project.output.dedup_key)
        if keys and project.output.dedup_scope == "table":
            rows = _new_keys(rows, stored.filter(~F.col("run_date").isin(write)), keys)
        elif keys:
            rows = dedup_keys(rows, list(dict.fromkeys([*keys, "run_date"])))  # one row per key and date
        _write_dates(rows, path)
        if replacing and present:
            # Dynamic overwrite leaves a date alone that gets no rows: clear those that still hold older ones.
            filled = set(stored_dates(rows if keys else df, present))
            empty = store.spark.createDataFrame([], T.StructType([f for f in schema if f.name != "run_date"]))
            for d in (d for d in present if d not in filled):
                empty.write.mode("overwrite").parquet(f"{path}/run_date={d.isoformat()}")
    return {d: "success" if d in write else "skipped" for d in days}


def save(
    store: Store, df: DataFrame, project: Project, run_date: str | date,
    created_at: datetime | Column | None = None,
) -> int:
    """Save the batch of one date; the number of rows written, 0 when the date was skipped."""
    dated = with_run_date(df, run_date)
    status = save_dates(store, dated, project, [run_date], created_at)
    day = date.fromisoformat(str(run_date))
    if status[day] == "skipped":
        return 0
    return store.result(project, dated.schema).filter(F.col("run_date") == F.lit(day)).count()


def run_rows(spark: SparkSession, rows: Sequence[tuple], created_at: datetime | None = None) -> DataFrame:
    """run_log rows from (project_id, run_date, status, row_count, duration_sec, error_message)."""
    values = [(p, date.fromisoformat(str(d)), s, n, round(float(t), 2), e) for p, d, s, n, t, e in rows]
    schema = T.StructType(RUN_LOG.fields[:-1])
    stamp = F.current_timestamp() if created_at is None else F.lit(created_at)
    return spark.createDataFrame(values, schema).coalesce(1).withColumn("created_at", stamp.cast("timestamp"))


def log_run(
    store: Store, project: Project, run_date: str | date, status: str, row_count: int = 0,
    duration_sec: float = 0.0, error_message: str | None = None, created_at: datetime | None = None,
) -> None:
    """Append one run to the run log."""
    row = (project.project_id, run_date, status, row_count, duration_sec, error_message)
    store.append_log("run_log", run_rows(store.spark, [row], created_at))


def monitoring_rows(report: DataFrame, created_at: datetime | None = None) -> DataFrame:
    """monitoring_log rows of a check report."""
    stamp = F.current_timestamp() if created_at is None else F.lit(created_at)
    return report.withColumn("created_at", stamp.cast("timestamp")).select(*MONITORING_LOG.names)


def log_checks(store: Store, report: DataFrame, created_at: datetime | None = None) -> None:
    store.append_log("monitoring_log", monitoring_rows(report, created_at))


def ingest_csv(
    store: Store, csv_path: str, table: str, sample_n: int | None = None, key: Sequence[str] = (),
    schema: str | None = None, seed: int = 42,
) -> DataFrame:
    """Replace a table with a CSV file, or a fixed-size sample of it; the stored table."""
    spark = store.spark
    rows = read_separated(spark, [csv_path], ",", schema)
    if sample_n is not None:
        rows = sample_rows(rows, sample_n, list(key) or rows.columns, seed)
    rows.write.mode("overwrite").parquet(store.path(table))
    return spark.read.parquet(store.path(table))
