"""Registered queries over the benchmark tables, and the same questions in SQL."""

from .oracle import oracle_sql
from .queries import queries

__all__ = ["oracle_sql", "queries"]
