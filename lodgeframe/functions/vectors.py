"""Vector expressions for single pairs; bulk search is in ``operators.similar``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 when either has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / norms)


def numeric_match(a: Column, b: Column) -> Column:
    """1 if equal, else 0; a missing side scores 0."""
    return F.when(a == b, F.lit(1.0)).otherwise(F.lit(0.0))


def categorical_match(a: Column, b: Column) -> Column:
    """1 if equal after trimming and lower-casing; a missing or blank side scores 0."""
    both = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return F.when(both & (F.lower(F.trim(a)) == F.lower(F.trim(b))), F.lit(1.0)).otherwise(F.lit(0.0))
