"""Queries over the supplied tables."""

from lodgeframe.queries import cleaning, documents, flows, search, tables  # noqa: F401
from lodgeframe.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
