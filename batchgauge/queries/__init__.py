"""Registered queries: every operator over the given tables, with the same question in SQL."""

from batchgauge.queries import (  # noqa: F401  (each module registers its queries)
    checks, drifts, evaluation, features, histories, loops, scores, tables,
)
from batchgauge.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
