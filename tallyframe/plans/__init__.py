"""Queries over the given tables, one per operator."""

from tallyframe.plans.registry import ORACLES, QUERIES
from tallyframe.plans import aggregations, documents, joins, nested, projections, reporting, resolution, storage, windows  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
