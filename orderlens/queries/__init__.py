"""Registered queries: every operator over the star-schema tables, with its oracle SQL.

A query and its oracle stand side by side. Oracles are plain SQL over the same tables;
queries without one train models or stream.
"""

from orderlens.queries.registry import ORACLES, QUERIES
from orderlens.queries import (  # noqa: F401  (registration)
    cleaning,
    customers,
    evaluation,
    layers,
    models,
    reports,
    tables,
)

__all__ = ["ORACLES", "QUERIES"]
