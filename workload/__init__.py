"""Registered queries: each runs one library operator over whole input tables,
next to the SQL that must give the same rows."""

from workload import bronze, gold, silver  # noqa: F401  (registers the queries)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
