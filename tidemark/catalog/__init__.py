"""Registered queries."""

from tidemark.catalog import assembly, ingest, models, partner, refine, reports, state  # noqa: F401  (they register themselves)
from tidemark.catalog.base import QUERIES

__all__ = ["QUERIES"]
