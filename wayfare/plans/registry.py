"""All queries of the library by name, and their SQL."""

from __future__ import annotations

from wayfare.plans import check_queries  # noqa: F401  (registers its queries)
from wayfare.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
