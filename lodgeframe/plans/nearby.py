"""Nearby and similar listings over search documents and vector points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators.documents import nearby_points
from lodgeframe.operators.nearest import nearest, within_radius
from lodgeframe.operators.similar import similar_all, similar_to
from lodgeframe.session import cut_lineage

_SHOWN = ["id", "property_name", "city", "country", "usd_price", "star_rating"]


def nearby_place(
    documents: DataFrame, lat: float, lon: float, radius_km: float = 5, limit: int = 20, published_only: bool = True
) -> DataFrame:
    """Listings around one place, nearest first, with ``distance_km``."""
    candidates = documents.where("published") if published_only else documents
    points = candidates.select(*_SHOWN, F.col("lonlat")[1].alias("lat"), F.col("lonlat")[0].alias("lon"))
    return within_radius(points, lat, lon, radius_km, limit).select(*_SHOWN, "distance_km")


def nearby_listings(
    documents: DataFrame, ids: DataFrame | None = None, radius_km: float = 5, limit: int = 20, published_only: bool = True
) -> DataFrame:
    """Listings near each source listing (all, or those in ``ids.id``), which need not be published."""
    sources = documents if ids is None else documents.join(ids, "id", "left_semi")
    targets = documents.where("published") if published_only else documents
    near = nearest(nearby_points(sources), nearby_points(targets), radius_km, limit)
    return near.join(documents.select(*_SHOWN), "id").select("source_id", "rank", *_SHOWN, "distance_km")


def similar_listings(points: DataFrame, ids: DataFrame | None = None, k: int = 5, published_only: bool = True) -> DataFrame:
    """Payload and score of the ``k`` most similar listings per source (all, or those in ``ids.id``)."""
    # Read for keys, members, vectors and payloads.
    points = cut_lineage(points.select("vector", "payload"))
    vectors = points.select(F.col("payload.external_id").alias("id"), "vector", F.coalesce("payload.published", F.lit(False)).alias("published"))
    found = similar_all(vectors, k, published_only) if ids is None else similar_to(vectors, ids, k, published_only)
    payloads = points.select(F.col("payload.external_id").alias("id"), "payload")
    return found.join(payloads, "id").select("source_id", "rank", "payload.*", "score")
