"""Joins of scored batches with labels, and of model names with versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from batchgauge.functions.columns import col
from batchgauge.session import written


def join_labels(
    scored: DataFrame, labels: DataFrame, ids: Sequence[str], label_column: str, lag_days: int,
    label_date: str = "label_date",
) -> DataFrame:
    """Scored rows with the label that arrived ``lag_days`` after their run_date.

    The date is one more equi-join key, so a run_date filter prunes both sides.
    """
    known = labels.select(
        *[col(i) for i in ids], col(label_column),
        F.date_sub(col(label_date).cast("date"), lag_days).alias("run_date"),
    )
    return scored.join(known, [*ids, "run_date"])


#: Aliases that go to every task; more of them are joined by a shuffle as the numbers are.
BROADCAST_ALIASES = 500_000


def resolve_models(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """Requests (name, version, …) with the version row they mean, or NULL if there is none.

    A version of digits is a version number; anything else is an alias. ``versions`` has
    name, version, and aliases (an array); one alias points to one version of a model. Nearly all requests may ask for
    one alias of one model: aliases, a few per model, go to every task after a check of their number, and only requests for
    numbers, which spread over the versions, are shuffled.
    """
    numbers = versions.select(
        "name", F.col("version").cast("string").alias("version"), F.col("version").alias("resolved_version")
    )
    aliases = written(
        versions.select("name", F.explode("aliases").alias("version"), F.col("version").alias("resolved_version")), "aliases"
    )
    if aliases.count() <= BROADCAST_ALIASES:
        aliases = F.broadcast(aliases)
    is_number = F.coalesce(F.col("version").rlike("^[0-9]+$"), F.lit(False))
    by_number = requests.filter(is_number).join(numbers, ["name", "version"], "left")
    by_alias = requests.filter(~is_number).join(aliases, ["name", "version"], "left")
    return by_number.unionByName(by_alias)


def active_projects(registry: DataFrame) -> DataFrame:
    """Active projects by id; ids that start with an underscore are examples."""
    return registry.filter(~F.col("project_id").startswith("_") & (F.col("status") == "active")).orderBy("project_id")
