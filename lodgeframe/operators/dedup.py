"""Keyed de-duplication with an explicit order, and id filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in the given order.

    ``max_by`` keeps one row per key and task before the shuffle, so a key that holds a large share of
    all rows never gathers in one task. NULL keys form one group, as any other value does.
    """
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*[F.col(k) for k in keys], *[F.col("_last")[c].alias(c) for c in rest]).select(*df.columns)


def keep_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is among ``ids.id``."""
    return df.join(ids.select(F.col("id").alias(column)), column, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not among ``ids.id``, NULL included."""
    return df.join(ids.select(F.col("id").alias(column)), column, "left_anti")
