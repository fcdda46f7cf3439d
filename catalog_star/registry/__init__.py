"""Registered queries over the driver's tables, each paired with comparison SQL."""

from catalog_star.registry.queries import QUERIES, Query

__all__ = ["QUERIES", "Query"]
