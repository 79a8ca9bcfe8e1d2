"""Registered queries: importing this package fills ``QUERIES`` and ``ORACLES``."""

from . import ingest, kmeans, models, relational, vectors  # noqa: F401
from .registry import ORACLES, QUERIES, query

__all__ = ["QUERIES", "ORACLES", "query"]
