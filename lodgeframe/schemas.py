"""Fixed schemas: raw feed records, the listing table and the compared columns."""

from __future__ import annotations

from pyspark.sql import types as T

# --- raw feed records -----------------------------------------------------------------
# Scalars are read as STRING because feeds send numbers both as numbers and as text; the
# cleaning step coerces them with try_cast.

_LANG_TEXT = "map<string,string>"

RAW_LISTING_DDL = f"""
    id string,
    name {_LANG_TEXT},
    accommodation_type string,
    accommodation_status string,
    min_stay string,
    work_friendly_home string,
    long_stay_friendly_home string,
    location struct<country: string, city: string, address: {_LANG_TEXT},
                    coordinates: struct<latitude: string, longitude: string>>,
    rating struct<stars: string, review_score: string, number_of_reviews: string>,
    rooms array<struct<number_of_rooms: struct<bedrooms: string, bathrooms: string>,
                       maximum_occupancy: struct<total_guests: string, children: string>>>,
    photos array<struct<main_photo: string, url: struct<standard: string, thumbnail: string>>>,
    facilities array<struct<id: string>>,
    policies struct<pets: struct<allowed: string>, minimum_checkin_age: string>,
    description struct<text: {_LANG_TEXT}, important_information: {_LANG_TEXT}>,
    url struct<web: string>,
    partner_location_id string
"""

SEARCH_RECORD_DDL = """
    id string,
    currency struct<booker: string>,
    price struct<base: struct<booker_currency: string>>,
    products array<struct<policies: struct<cancellation: struct<type: string>>>>
"""

PARTNER_ROW_DDL = """
    external_id string, id string, latlon string, property_name string, property_type string,
    location_display string, property_description string, other_policy string,
    bedroom_count string, bathroom_count string
"""

CHANGE_EVENT_DDL = "date string, feed_provider_ids array<string>"


# --- listing table ----------------------------------------------------------------------


def _fields(kind: T.DataType, names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names.split(), kind)


_TYPES: dict[str, T.DataType] = {
    **_fields(
        T.StringType(),
        "external_id feed_provider_id feed_provider_url property_name property_slug property_type "
        "property_type_category city country country_code location_display partner_location_id latlon "
        "language currency feature_image policy property_flags other_policy feature_summary "
        "property_description raw_data",
    ),
    **_fields(
        T.IntegerType(),
        "feed star_rating number_of_review bedroom_count bathroom_count occupancy max_occupancy min_stay",
    ),
    **_fields(T.DecimalType(4, 2), "review_score review_score_general"),
    **_fields(T.DecimalType(10, 2), "price"),
    **_fields(T.ArrayType(T.StringType()), "images amenities amenity_categories"),
    **_fields(T.BooleanType(), "family_friendly group_friendly is_published"),
    **_fields(T.TimestampType(), "source_created_at source_updated_at last_synced_at created_at"),
}

# Column order of the staged rows (39) and of the table (43).
STAGED_COLUMNS = (
    "external_id feed feed_provider_id feed_provider_url property_name property_slug property_type "
    "property_type_category city country country_code location_display partner_location_id latlon language "
    "star_rating review_score review_score_general number_of_review bedroom_count bathroom_count occupancy "
    "max_occupancy currency price min_stay feature_image images family_friendly group_friendly amenities "
    "amenity_categories policy property_flags other_policy feature_summary property_description is_published "
    "raw_data"
).split()
LISTING_COLUMNS = STAGED_COLUMNS[:-1] + [
    "source_created_at",
    "source_updated_at",
    "raw_data",
    "last_synced_at",
    "created_at",
]

STAGED_SCHEMA = T.StructType([T.StructField(c, _TYPES[c]) for c in STAGED_COLUMNS])
LISTING_SCHEMA = T.StructType([T.StructField(c, _TYPES[c]) for c in LISTING_COLUMNS])

LISTING_KEY = "feed_provider_id"

# Columns a snapshot comparison looks at: all staged ones but the key, the raw record, the texts
# that are derived or long, and the two guest flags.
_NOT_COMPARED = {
    LISTING_KEY,
    "language",
    "family_friendly",
    "group_friendly",
    "other_policy",
    "feature_summary",
    "property_description",
    "raw_data",
}
COMPARE_COLUMNS = [c for c in STAGED_COLUMNS if c not in _NOT_COMPARED]
