"""From raw listing records to staged table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.functions.geo import point_text
from lodgeframe.functions.text import (
    blank_to_null,
    slugify,
    strip_html,
    to_decimal,
    to_int,
    trimmed_or_blank,
    truthy,
)
from lodgeframe.sources.lookups import Lookups

# The source's feed number, id prefix, language and texts.
FEED = 11
ID_PREFIX = "BC-"
LANGUAGE = "en-us"
PETS_TEXT = {"no": "Pets are not allowed", "yes": "Pets are allowed"}
PETS_UNKNOWN = "Pet policy not specified"
ADULTS_ONLY_TEXT = "Only adults are allowed to check in"
ANY_AGE_TEXT = "Anyone can check in"
ADULT_AGE = 18
GROUP_GUESTS = 6


def english(c: Column) -> Column:
    return c[LANGUAGE]


def feature_image_and_images(photos: Column) -> tuple[Column, Column]:
    """Main photo's URL (else the first one's, else '') and all non-empty photo URLs."""
    urls = F.filter(F.transform(photos, lambda p: p["url"]["standard"]), lambda u: F.coalesce(u != "", F.lit(False)))
    images = F.coalesce(urls, F.array().cast("array<string>"))
    main = F.try_element_at(F.filter(photos, lambda p: truthy(p["main_photo"])), F.lit(1))["url"]["standard"]
    return F.coalesce(blank_to_null(main), F.try_element_at(images, F.lit(1)), F.lit("")), images


def pets_policy_text(allowed: Column) -> Column:
    out = F.lit(PETS_UNKNOWN)
    for value, text in PETS_TEXT.items():
        out = F.when(allowed == value, F.lit(text)).otherwise(out)
    return out


def adults_only(min_age: Column) -> Column:
    return F.coalesce(min_age >= ADULT_AGE, F.lit(False))


def checkin_age_text(min_age: Column) -> Column:
    return F.when(adults_only(min_age), F.lit(ADULTS_ONLY_TEXT)).otherwise(F.lit(ANY_AGE_TEXT))


def eco_friendly(information: Column) -> Column:
    return F.coalesce(F.lower(information).rlike("eco[ -]friendly"), F.lit(False))


def group_friendly(guests: Column) -> Column:
    return F.coalesce(guests.try_cast("double") >= GROUP_GUESTS, F.lit(False))


def json_object(**fields: Column) -> Column:
    """JSON text of an object that keeps its NULL fields."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def policy_json(allowed: Column, min_age: Column, free_cancellation: Column) -> Column:
    return json_object(
        pets_allowed=F.coalesce(allowed == "yes", F.lit(False)),
        pets_policy_text=pets_policy_text(allowed),
        adults_only_checkin=adults_only(min_age),
        checkin_age_policy_text=checkin_age_text(min_age),
        minimum_checkin_age=min_age,
        free_cancellation=F.coalesce(free_cancellation, F.lit(False)),
    )


def property_flags_json(work: Column, long_stay: Column, information: Column, min_age: Column) -> Column:
    return json_object(
        work_friendly_home=truthy(work),
        long_stay_friendly_home=truthy(long_stay),
        eco_friendly_home=eco_friendly(information),
        adult_only=adults_only(min_age),
    )


def facility_columns(exploded: DataFrame, keys: list[str]) -> DataFrame:
    """Amenity columns per listing from rows ``(*keys, pos, facility_name, category)``.

    ``amenities`` keeps order and repeats; ``amenity_categories`` is distinct in order of first
    appearance; ``feature_summary`` is JSON text with each category's names joined by line breaks. All
    come from one grouping, so the rows are shuffled once. A group holds one listing's facilities.
    """
    item = F.struct("pos", "facility_name", "category")
    sorted_items = exploded.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    items = F.col("_items")
    names = F.filter(F.transform(items, lambda i: i["facility_name"]), lambda n: n.isNotNull())
    categories = F.array_distinct(F.filter(F.transform(items, lambda i: i["category"]), lambda c: c.isNotNull()))
    complete = F.filter(items, lambda i: i["facility_name"].isNotNull() & i["category"].isNotNull())

    def described(category: Column) -> Column:
        own = F.filter(complete, lambda i: i["category"] == category)
        return F.struct(
            category.alias("name"), F.array_join(F.transform(own, lambda i: i["facility_name"]), "\n").alias("description")
        )

    summary = F.transform(F.array_distinct(F.transform(complete, lambda i: i["category"])), described)
    return sorted_items.select(
        *keys,
        names.alias("amenities"),
        categories.alias("amenity_categories"),
        F.to_json(summary).alias("feature_summary"),
    )


def resolve_facilities(listings: DataFrame, facilities: DataFrame, keys: list[str]) -> DataFrame:
    """``facility_columns`` for listings with an array column ``facilities`` of structs with ``id``."""
    exploded = listings.select(*keys, F.posexplode("facilities").alias("pos", "f"))
    named = exploded.select(*keys, "pos", F.col("f.id").alias("facility_id")).join(facilities, "facility_id")
    return facility_columns(named, keys)


def resolve_places(df: DataFrame, countries: DataFrame, cities: DataFrame) -> DataFrame:
    """Adds ``country`` and ``city`` from ``country_code`` (any case) and ``city_code``; '' if unknown."""
    keyed = df.withColumn("country_key", F.lower("country_code"))
    joined = keyed.join(countries, "country_key", "left").join(cities, ["country_key", "city_code"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in ("country", "city")}).drop("country_key")


def resolve_types(df: DataFrame, types: DataFrame, categories: DataFrame) -> DataFrame:
    """Adds ``property_type`` and ``property_type_category`` from ``type_code``; '' if unknown."""
    names = types.select(F.col("code").alias("type_code"), F.col("type_name").alias("property_type"))
    groups = categories.select(F.col("type_name").alias("property_type"), F.col("category").alias("property_type_category"))
    joined = df.join(names, "type_code", "left").join(groups, "property_type", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in ("property_type", "property_type_category")})


ORDER = ["_bucket", "_file", "_pos"]


def parse_records(raw: DataFrame) -> DataFrame:
    """Typed view of ``raw_data`` beside the text itself; ``r`` is NULL where the text is no record."""
    parsed = F.from_json("raw_data", schemas.RAW_LISTING_DDL)
    return raw.withColumn("r", F.when(F.col("raw_data").startswith("{"), parsed))


def assemble_rows(records: DataFrame, prices: DataFrame, lookups: Lookups) -> DataFrame:
    """Staged rows for parsed records, in the column order of the table, plus the order columns."""
    r = F.col("r")
    room = F.try_element_at(r["rooms"], F.lit(1))
    guests = room["maximum_occupancy"]["total_guests"]
    min_age = to_int(r["policies"]["minimum_checkin_age"])
    information = english(r["description"]["important_information"])
    feature, images = feature_image_and_images(r["photos"])
    listing_id = trimmed_or_blank(r["id"])
    name = trimmed_or_blank(english(r["name"]))
    score = r["rating"]["review_score"]
    location = r["location"]

    base = records.withColumn("price_id", r["id"]).withColumn("type_code", r["accommodation_type"])
    base = base.withColumn("country_code", F.coalesce(location["country"], F.lit(""))).withColumn("city_code", location["city"])
    offers = prices.select(
        F.col("id").alias("price_id"),
        F.col("currency").alias("offer_currency"),
        F.col("price").alias("offer_price"),
        F.col("free_cancellation").alias("offer_free"),
    )
    joined = base.join(offers, "price_id", "left")
    joined = resolve_places(resolve_types(joined, lookups.types, lookups.categories), lookups.countries, lookups.cities)

    facility_keys = ORDER
    with_facilities = records.select(*facility_keys, r["facilities"].alias("facilities"))
    amenities = resolve_facilities(with_facilities, lookups.facilities, facility_keys)
    joined = joined.join(amenities, facility_keys, "left")

    no_text = F.array().cast("array<string>")
    columns = {
        "external_id": F.concat(F.lit(ID_PREFIX), listing_id),
        "feed": F.lit(FEED),
        "feed_provider_id": listing_id,
        "feed_provider_url": trimmed_or_blank(r["url"]["web"]),
        "property_name": name,
        "property_slug": slugify(name),
        "location_display": trimmed_or_blank(english(location["address"])),
        "partner_location_id": F.coalesce(r["partner_location_id"], F.lit("")),
        "latlon": point_text(location["coordinates"]["latitude"], location["coordinates"]["longitude"]),
        "language": F.lit(LANGUAGE),
        "star_rating": to_int(r["rating"]["stars"]),
        "review_score": to_decimal(score, 4, 2),
        "review_score_general": to_decimal(score.try_cast("double") / 2, 4, 2),
        "number_of_review": F.when(truthy(r["rating"]["number_of_reviews"]), to_int(r["rating"]["number_of_reviews"])).otherwise(F.lit(0)),
        "bedroom_count": to_int(room["number_of_rooms"]["bedrooms"]),
        "bathroom_count": to_int(room["number_of_rooms"]["bathrooms"]),
        "occupancy": to_int(guests),
        "max_occupancy": to_int(guests),
        "currency": F.coalesce(blank_to_null(F.col("offer_currency")), F.lit("USD")),
        "price": to_decimal(F.col("offer_price"), 10, 2),
        "min_stay": F.when(truthy(r["min_stay"]), to_int(r["min_stay"])).otherwise(F.lit(1)),
        "feature_image": feature,
        "images": images,
        "family_friendly": room["maximum_occupancy"]["children"].isNotNull(),
        "group_friendly": group_friendly(guests),
        "amenities": F.coalesce("amenities", no_text),
        "amenity_categories": F.coalesce("amenity_categories", no_text),
        "policy": policy_json(r["policies"]["pets"]["allowed"], min_age, F.col("offer_free")),
        "property_flags": property_flags_json(r["work_friendly_home"], r["long_stay_friendly_home"], information, min_age),
        "other_policy": trimmed_or_blank(information),
        "feature_summary": F.coalesce("feature_summary", F.lit("[]")),
        "property_description": strip_html(english(r["description"]["text"])),
        "is_published": F.coalesce(r["accommodation_status"] == "open", F.lit(False)),
    }
    typed = [columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.STAGED_SCHEMA.fields]
    return joined.select(*typed, *ORDER)
