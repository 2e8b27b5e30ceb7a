"""All queries of the verification engine, and their SQL where there is one."""

from __future__ import annotations

from . import queries_checks, queries_dates, queries_files, queries_increments, queries_levels, queries_more  # noqa: F401  register their queries
from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
