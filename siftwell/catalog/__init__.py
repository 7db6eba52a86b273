"""Registered queries: every operator over whole tables, with an SQL text to check it."""

from siftwell.catalog import cleaning, outliers, profiles, runs, sources  # noqa: F401
from siftwell.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
