"""The registered queries: each runs library functions over the given tables."""

from tidemark.plans.queries import jobs, marts, sources, tables, worklists  # noqa: F401
from tidemark.plans.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
