"""Checked queries: each operator on the given tables, with the SQL that must give the same rows."""

from . import cleaning, extraction, flows, relations, scans, statistics, texts  # noqa: F401
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
