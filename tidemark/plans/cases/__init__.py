"""Registered queries: each operator on the test tables, with the SQL that must give the same rows."""

from . import columns, files, gold, models, quality, sqlcases  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
