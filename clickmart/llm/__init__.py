"""Training-data operators; nothing else in the library imports this subpackage."""

from __future__ import annotations

from .queries import ORACLE_SQL, QUERIES, oracle_sql, queries

__all__ = ["ORACLE_SQL", "QUERIES", "oracle_sql", "queries"]
