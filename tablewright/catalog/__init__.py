"""Runnable queries, one per operator, with the SQL that must give the same rows."""

from tablewright.catalog import files, mapped, tables
from tablewright.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "files", "mapped", "tables"]
