"""Points, great-circle distance and grid cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeframe.functions.text import blank_to_null

EARTH_RADIUS_M = 6_371_000.0  # fixed value

_POINT = r"POINT\s*\(\s*([-\d.]+)\s+([-\d.]+)\s*\)"


def _number_text(c: Column) -> Column:
    """Plain decimal text of a double; Spark switches to exponents below 1e-3."""
    small = F.regexp_replace(c.cast("decimal(38,20)").cast("string"), "0+$", "")
    return F.when((F.abs(c) < 1e-3) & (c != 0), small).otherwise(c.cast("string"))


def point_text(lat: Column, lon: Column) -> Column:
    """EWKT text ``SRID=4326;POINT (lon lat)``; NULL unless both coordinates are finite numbers."""
    la, lo = lat.try_cast("double"), lon.try_cast("double")
    finite = (F.abs(la) < float("inf")) & (F.abs(lo) < float("inf"))
    return F.when(finite, F.concat(F.lit("SRID=4326;POINT ("), _number_text(lo), F.lit(" "), _number_text(la), F.lit(")")))


def point_lon_text(c: Column) -> Column:
    """Longitude of an EWKT point, as the text it holds."""
    return blank_to_null(F.regexp_extract(c, _POINT, 1))


def point_lat_text(c: Column) -> Column:
    return blank_to_null(F.regexp_extract(c, _POINT, 2))


def point_lon(c: Column) -> Column:
    return point_lon_text(c).try_cast("double")


def point_lat(c: Column) -> Column:
    return point_lat_text(c).try_cast("double")


def _json_number(c: Column, path: str) -> Column:
    return F.get_json_object(c, path).try_cast("double")


def any_point(c: Column) -> Column:
    """(lat, lon) of EWKT text or of a JSON object in one of three shapes; NULL if none fits."""
    pair = F.from_json(F.get_json_object(c, "$.coordinates"), "array<double>")

    def point(lat: Column, lon: Column) -> Column:
        return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))

    is_object = F.ltrim(c).startswith("{")
    return F.when(
        is_object,
        F.coalesce(
            point(_json_number(c, "$.lat"), _json_number(c, "$.lon")),
            point(_json_number(c, "$.latitude"), _json_number(c, "$.longitude")),
            F.when(F.size(pair) == 2, point(pair[1], pair[0])),
        ),
    ).otherwise(point(point_lat(c), point_lon(c)))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    dphi = F.radians(lat2 - lat1) / 2
    dlam = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dphi), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlam), F.lit(2.0))
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def on_sphere(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Metres along three axes. Straight-line distance never exceeds the distance on the surface,
    so a cube grid over these axes blocks a radius join, with no special case at ±180° or the poles."""
    phi, lam = F.radians(lat), F.radians(lon)
    return (
        EARTH_RADIUS_M * F.cos(phi) * F.cos(lam),
        EARTH_RADIUS_M * F.cos(phi) * F.sin(lam),
        EARTH_RADIUS_M * F.sin(phi),
    )
