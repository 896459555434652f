"""Registered queries and the tables that they derive from the given ones."""

from aeroskein.plans import archive_queries, io_queries, model_queries, observed_queries, spline_queries, weather_queries  # noqa: F401  importing registers them
from aeroskein.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
