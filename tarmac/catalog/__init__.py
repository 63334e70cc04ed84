"""Registered queries and their checking SQL."""

from tarmac.catalog.base import ORACLES, QUERIES
from tarmac.catalog import explore, history, models, prepare, scans, scores, statistics  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
