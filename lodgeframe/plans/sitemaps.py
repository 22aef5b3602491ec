"""Sitemap flows over the listing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from lodgeframe.operators.documents import nearby_points, search_documents
from lodgeframe.operators.nearest import nearest
from lodgeframe.operators.sitemap import Site, nearby_sitemap_rows
from lodgeframe.sinks.sitemaps import write_sitemaps
from lodgeframe.sources.tables import sitemap_rows


def listing_sitemap(listings: DataFrame, folder: str, site: Site, run_ts: Column) -> list[str]:
    """Sitemap of all published listings."""
    return write_sitemaps(sitemap_rows(listings), folder, "property-sitemap", site, run_ts)


def nearby_sitemap(listings: DataFrame, folder: str, site: Site, run_ts: Column, radius_km: float = 5, limit: int = 20) -> list[str]:
    """Sitemap of all listings that are near some published listing."""
    documents = search_documents(listings).where("published")
    points = nearby_points(documents)
    rows = nearby_sitemap_rows(nearest(points, points, radius_km, limit), documents)
    return write_sitemaps(rows, folder, "nearby-sitemap", site, run_ts)
