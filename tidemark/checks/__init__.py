"""The operators on the driver's tables, each with the SQL that must give the same rows."""

from tidemark.checks import batch, history, streams  # noqa: F401  (fill the registry)
from tidemark.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
