"""Registered queries over the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from .base import ORACLES, QUERIES
from . import check_queries, chain_queries, dump_queries, path_queries, report_queries  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
