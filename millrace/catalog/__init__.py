"""Queries over the given tables, one or more per operator."""

from millrace.catalog import checks, models, relational, streams, writes
from millrace.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "checks", "models", "relational", "streams", "writes"]
