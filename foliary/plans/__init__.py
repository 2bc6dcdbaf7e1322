"""Queries that apply the operators to the shared tables, with the SQL that gives the same rows."""

from . import extraction, files, media, records, upkeep  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
