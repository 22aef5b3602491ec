"""Listing-catalogue analytics expressed as Spark DataFrame plans."""

from lodgeframe.session import build_session, cut_lineage

__all__ = ["build_session", "cut_lineage"]
