"""Registered queries over the given tables and their SQL counterparts."""

from tallyroom.catalog.oracle import oracle_sql
from tallyroom.catalog.queries import queries

__all__ = ["oracle_sql", "queries"]
