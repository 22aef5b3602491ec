"""Duplicates between the listing table and a partner's file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgeframe.operators.duplicates import best_first, find_duplicates, ranked_matches
from lodgeframe.sources.partner import partner_rows
from lodgeframe.sources.tables import comparison_rows


def partner_duplicates(spark: SparkSession, listings: DataFrame, partner_path: str, **options) -> DataFrame:
    """``(source_id, candidate_id, distance_m, scores)`` of near and like pairs, the best match first.

    Of the table only the nine compared columns are read; ``options`` are those of ``find_duplicates``.
    """
    return best_first(find_duplicates(comparison_rows(listings), partner_rows(spark, partner_path), **options))


def ranked_partner_duplicates(spark: SparkSession, listings: DataFrame, partner_path: str, **options) -> DataFrame:
    """The rows of ``partner_duplicates`` with ``rank``, their place in that order, in no order themselves."""
    return ranked_matches(find_duplicates(comparison_rows(listings), partner_rows(spark, partner_path), **options))
