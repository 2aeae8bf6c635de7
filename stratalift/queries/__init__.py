"""Queries over the test tables, one or more per operator, each with its SQL where SQL can say it."""

from stratalift.queries import columns, filters, kept, layers, merges, metrics, rows, sources  # noqa: F401
from stratalift.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
