"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_FLOATS = (T.FloatType, T.DoubleType)

# Text marks per alert severity; any other severity gets the last one.
SEVERITY_PREFIX = {"critical": "[!!!]", "warning": "[!]", "info": "[i]"}
UNKNOWN_PREFIX = "[?]"


def col(name: str) -> Column:
    """Column by exact name; names such as ``rate/SOE`` need the quoting."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def missing(df: DataFrame, name: str) -> Column:
    """True for NULL and, in floating columns, NaN."""
    if isinstance(df.schema[name].dataType, _FLOATS):
        return col(name).isNull() | F.isnan(col(name))
    return col(name).isNull()


def nan_to_null(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """NaN in floating columns becomes NULL, so that one test finds what is missing."""
    floats = [
        f.name for f in df.schema
        if isinstance(f.dataType, _FLOATS) and (names is None or f.name in names)
    ]
    return df.withColumns({n: F.when(~F.isnan(col(n)), col(n)) for n in floats}) if floats else df


def outside(df: DataFrame, name: str, low: float, high: float) -> Column:
    """Below ``low`` or above ``high``; a missing value is neither."""
    return ~missing(df, name) & ((col(name) < low) | (col(name) > high))


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep…, column, value) with one row per cell; missing values are NULL rows."""
    cells = df.select(
        *[col(k) for k in keep],
        *[present(df, c).alias(c) for c in columns],
    )
    return cells.unpivot([col(k) for k in keep], [col(c) for c in columns], "column", "value")


def present(df: DataFrame, name: str) -> Column:
    """The value as double, NULL where it is missing."""
    return F.when(~missing(df, name), col(name).cast("double"))


def per_column(
    df: DataFrame, columns: Sequence[str], stats: Mapping[str, Callable[[str], Column]], by: Sequence[str] = ()
) -> DataFrame:
    """by…, column and one field per statistic: one wide aggregate, turned long afterwards.

    The rows themselves are not multiplied by the number of columns.
    """
    wide = df.groupBy(*[col(b) for b in by]).agg(F.count("*").alias("_n"), *[
        make(c).alias(f"_{i}_{name}") for i, c in enumerate(columns) for name, make in stats.items()
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}_{name}").alias(name) for name in stats])
        for i, c in enumerate(columns)
    ])
    return wide.select(*[col(b) for b in by], F.inline(rows))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator, F.lit(0))


def log_floor(x: Column, floor: float = 1.0) -> Column:
    """ln of x raised to at least ``floor``; greatest() alone would fill in missing values."""
    return F.when(x.isNotNull(), F.ln(F.greatest(x, F.lit(floor))))


def indicator(x: Column, value) -> Column:
    return x.eqNullSafe(F.lit(value)).cast("int")


def standardise(x: Column, mean: float, std: float) -> Column:
    """Apply a fitted scaler; a constant column (std 0) is only centred."""
    return (x - F.lit(float(mean))) / F.lit(float(std) if std else 1.0)


def unit_interval(x: Column, low: float | None, high: float | None) -> Column:
    """Min-max to [0, 1]; a constant column is 0.5, and a column without values stays missing."""
    if low is None or high is None:
        return F.lit(None).cast("double")
    if low == high:
        return F.lit(0.5)
    return (x - F.lit(float(low))) / F.lit(float(high) - float(low))


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def run_date_range(start: Column, end: Column) -> Column:
    """Every day from start to end, both included; no days when end is before start."""
    days = F.sequence(start.cast("date"), F.greatest(start, end).cast("date"), F.expr("interval 1 day"))
    return F.when(end >= start, days).otherwise(F.slice(days, 1, 0))


def severity_prefix(severity: Column) -> Column:
    out = F.lit(UNKNOWN_PREFIX)
    for name, mark in SEVERITY_PREFIX.items():
        out = F.when(severity == name, F.lit(mark)).otherwise(out)
    return out


def hash_hex(keys: Sequence[Column], seed: int, salt: str = "") -> Column:
    """32 hex digits that depend only on the key and the seed, not on partitioning or retries."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(f"{seed}{salt}")))


def hash_uniform(keys: Sequence[Column], seed: int, salt: str = "") -> Column:
    """A reproducible draw from (0, 1) per key."""
    digits = F.conv(F.substring(hash_hex(keys, seed, salt), 1, 12), 16, 10).cast("double")
    return (digits + 0.5) / float(16**12)


def hash_normal(keys: Sequence[Column], seed: int) -> Column:
    """A reproducible standard normal draw per key (Box-Muller)."""
    u, v = hash_uniform(keys, seed, "u"), hash_uniform(keys, seed, "v")
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(6.283185307179586) * v)
