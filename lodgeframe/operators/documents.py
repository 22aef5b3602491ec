"""Projections of the listing table into the documents other systems take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.geo import point_lat_text, point_lon, point_lat, point_lon_text
from lodgeframe.functions.ids import uuid5_dns
from lodgeframe.functions.text import blank_to_null, iso_timestamp

_POLICY = (
    "pets_allowed boolean, pets_policy_text string, adults_only_checkin boolean, checkin_age_policy_text string, "
    "minimum_checkin_age int, free_cancellation boolean, other_policy string"
)
_FLAGS = "work_friendly_home boolean, long_stay_friendly_home boolean, eco_friendly_home boolean, adult_only boolean"
_NO_TEXT = "array<string>"


def _or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(_NO_TEXT))


def lonlat(latlon: Column) -> Column:
    """``[lon, lat]`` of an EWKT point, or NULL."""
    lon, lat = point_lon(latlon), point_lat(latlon)
    return F.when(lon.isNotNull() & lat.isNotNull(), F.array(lon, lat))


def property_attributes(family: Column, group: Column, free_cancellation: Column) -> Column:
    """Names of the attributes that hold, always in this order."""
    named = {"Family Friendly": family, "Group Friendly": group, "Free Cancellation": free_cancellation}
    return F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in named.items()]))


def search_documents(listings: DataFrame) -> DataFrame:
    """One search document per listing row."""
    policy = F.from_json("policy", _POLICY)
    flags = F.from_json("property_flags", "map<string,boolean>")
    same = (
        "feed_provider_id feed feed_provider_url property_name property_slug property_type property_type_category "
        "city country country_code"
    ).split()
    return listings.select(
        F.col("external_id").alias("id"),
        *same,
        F.col("location_display").alias("display"),
        lonlat(F.col("latlon")).alias("lonlat"),
        "star_rating",
        F.col("review_score_general").cast("double").alias("review_score_general"),
        "number_of_review",
        "bedroom_count",
        "bathroom_count",
        "occupancy",
        F.col("price").cast("double").alias("usd_price"),
        "min_stay",
        "feature_image",
        "amenity_categories",
        F.coalesce(flags, F.create_map().cast("map<string,boolean>")).alias("property_flags"),
        property_attributes(F.col("family_friendly"), F.col("group_friendly"), policy["free_cancellation"]).alias("property_attributes"),
        F.col("is_published").alias("published"),
        iso_timestamp(F.col("created_at")).alias("created_at"),
        iso_timestamp(F.col("last_synced_at")).alias("updated_at"),
    )


def nearby_points(documents: DataFrame) -> DataFrame:
    """``(id, lat, lon)`` of search documents, the input of the radius operators."""
    return documents.select("id", F.col("lonlat")[1].alias("lat"), F.col("lonlat")[0].alias("lon"))


def export_documents(listings: DataFrame) -> DataFrame:
    """One nested export document per listing row."""
    policy, flags = F.from_json("policy", _POLICY), F.from_json("property_flags", _FLAGS)
    images = _or_empty(F.col("images"))

    def pick(source: str, name: str) -> Column:
        return F.col(source).alias(name)

    partner = F.struct(
        _or_empty(F.col("amenities")).alias("Amenities"),
        F.struct(
            F.when(policy["free_cancellation"], "Free cancellation").otherwise("No free cancellation").alias("CancellationPolicy"),
            policy["checkin_age_policy_text"].alias("CheckinPolicy"),
            policy["pets_policy_text"].alias("PetPolicy"),
        ).alias("Policies"),
        pick("feed_provider_url", "URL"),
    )
    prop = F.struct(
        _or_false(policy["adults_only_checkin"]).alias("AdultOnly"),
        _or_empty(F.col("amenity_categories")).alias("Amenities"),
        F.struct(
            pick("bathroom_count", "Bathroom"),
            pick("bedroom_count", "Bedroom"),
            pick("occupancy", "Occupancy"),
            pick("number_of_review", "Reviews"),
        ).alias("Counts"),
        pick("feature_image", "FeatureImage"),
        F.struct(F.size(images).alias("Count"), images.alias("Images")).alias("Image"),
        policy["other_policy"].alias("OtherPolicy"),
        pick("property_description", "PropertyDescription"),
        F.array().cast(_NO_TEXT).alias("ImageAnalysis"),
        _or_false(policy["pets_allowed"]).alias("IsPetFriendly"),
        _or_false(flags["long_stay_friendly_home"]).alias("LongStayFriendlyHome"),
        pick("min_stay", "MinStay"),
        F.col("price").cast("double").alias("Price"),
        pick("property_name", "PropertyName"),
        pick("property_slug", "PropertySlug"),
        pick("property_type", "PropertyType"),
        F.col("review_score_general").cast("double").alias("ReviewScore"),
        pick("star_rating", "StarRating"),
        iso_timestamp(F.col("last_synced_at")).alias("UpdatedAt"),
        _or_false(flags["work_friendly_home"]).alias("WorkFriendlyHome"),
    )
    return listings.select(
        pick("feed", "Feed"),
        pick("city", "City"),
        pick("country", "Country"),
        pick("country_code", "CountryCode"),
        pick("location_display", "Display"),
        point_lat_text(F.col("latlon")).alias("Lat"),
        point_lon_text(F.col("latlon")).alias("Lng"),
        pick("partner_location_id", "LocationID"),
        pick("external_id", "ID"),
        partner.alias("Partner"),
        prop.alias("Property"),
        pick("is_published", "Published"),
    )


def kv_items(listings: DataFrame, *extra: str) -> DataFrame:
    """History items keyed by ``(property_id, timestamp)``; the timestamp is the day of the last sync."""
    return listings.select(
        *extra,
        "country_code",
        "language",
        F.col("external_id").alias("property_id"),
        "property_name",
        "property_slug",
        F.col("is_published").alias("published"),
        F.date_format("last_synced_at", "yyyyMMdd").alias("timestamp"),
        F.col("price").alias("usd_price"),
    )


# The phrase each flag contributes to the embedding text.
FLAG_PHRASES = {
    "IsPetFriendly": "pet friendly",
    "AdultOnly": "adults only",
    "LongStayFriendlyHome": "long stay friendly",
    "WorkFriendlyHome": "work friendly",
}


def joined_text(parts: list[Column], amenity_lists: list[Column], flags: dict[str, Column]) -> Column:
    """Non-empty parts, comma-joined lists and phrases of set flags, joined by `` | ``."""
    lists = [blank_to_null(F.array_join(a, ", ")) for a in amenity_lists]
    phrases = [F.when(flag, F.lit(phrase)) for phrase, flag in flags.items()]
    return F.concat_ws(" | ", *[blank_to_null(p) for p in parts], *lists, *phrases)


def embedding_text(documents: DataFrame) -> Column:
    """Text that stands for an export document in similarity search; '' when it has none."""
    p = F.col("Property")
    names = documents.schema["Property"].dataType.names
    optional = [p[f] for f in ("PropertyName", "PropertyType", "PropertyTypeCategory") if f in names]
    return joined_text(
        [*optional, F.col("City"), F.col("Country"), p["PropertyDescription"]],
        [p["Amenities"], F.col("Partner.Amenities")],
        {phrase: p[f] for f, phrase in FLAG_PHRASES.items()},
    )


def embeddable(documents: DataFrame) -> DataFrame:
    """Documents that can become a vector point, with their ``embedding_text``."""
    with_text = documents.withColumn("embedding_text", embedding_text(documents))
    return with_text.where((F.coalesce("ID", F.lit("")) != "") & (F.col("embedding_text") != ""))


def vector_points(documents: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(point_id, vector, payload)`` of embeddable documents that have a vector; ``vectors`` is ``(text, vector)``."""
    return _pointed(documents, vectors).where(F.col("vector").isNotNull()).select("point_id", "vector", "payload")


def skipped_documents(documents: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(external_id, reason)`` of documents that become no vector point: no id, no text, or no vector for the text."""
    text = documents.withColumn("embedding_text", embedding_text(documents))
    reason = F.when(F.coalesce("ID", F.lit("")) == "", "no id").when(F.col("embedding_text") == "", "no text")
    unfit = text.select(F.col("ID").alias("external_id"), reason.alias("reason")).where(F.col("reason").isNotNull())
    lacking = _pointed(documents, vectors).where(F.col("vector").isNull())
    return unfit.unionByName(lacking.select(F.col("payload.external_id").alias("external_id"), F.lit("no vector").alias("reason")))


def _pointed(documents: DataFrame, vectors: DataFrame) -> DataFrame:
    """Every embeddable document with its point; ``vector`` is NULL where none is known."""
    p, counts = F.col("Property"), F.col("Property.Counts")
    payload = F.struct(
        F.col("ID").alias("external_id"),
        p["PropertyName"].alias("property_name"),
        p["PropertyType"].alias("property_type"),
        F.col("City").alias("city"),
        F.col("Country").alias("country"),
        p["Price"].alias("usd_price"),
        F.col("Published").alias("published"),
        p["FeatureImage"].alias("feature_image"),
        p["StarRating"].alias("star_rating"),
        p["ReviewScore"].alias("review_score"),
        counts["Bedroom"].alias("bedroom_count"),
        counts["Bathroom"].alias("bathroom_count"),
        counts["Occupancy"].alias("occupancy"),
        p["MinStay"].alias("min_stay"),
        _or_false(p["IsPetFriendly"]).alias("is_pet_friendly"),
        _or_false(p["AdultOnly"]).alias("adult_only"),
        _or_false(p["LongStayFriendlyHome"]).alias("long_stay_friendly_home"),
        _or_false(p["WorkFriendlyHome"]).alias("work_friendly_home"),
    )
    ready = embeddable(documents).withColumn("_key", F.md5("embedding_text"))
    keyed = vectors.where(F.col("vector").isNotNull()).select(F.md5("text").alias("_key"), "vector").dropDuplicates(["_key"])
    return ready.join(keyed, "_key", "left").select(uuid5_dns(F.col("ID")).alias("point_id"), "vector", payload.alias("payload"))
