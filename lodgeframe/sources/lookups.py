"""Static lookup files as small DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.functions.text import blank_to_null
from lodgeframe.operators.dedup import keep_last
from lodgeframe.session import broadcast_if_small
from lodgeframe.sources.paths import exists, matches

_NAMED = "struct<name: map<string,string>, facility_type: string>"


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as ``(value, _file)``; no rows if the file is missing."""
    if not matches(spark, path):
        return spark.createDataFrame([], "value string, _file string")
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("_file"))


def static_map(spark: SparkSession, root: str, relative: str, section: str = "$") -> DataFrame:
    """Any flat ``{key: value}`` lookup file as ``(key, value)``; values keep their JSON text."""
    docs = _documents(spark, f"{root}/{relative}")
    body = F.col("value") if section == "$" else F.get_json_object("value", section)
    return docs.select(F.explode(F.from_json(body, "map<string,string>")).alias("key", "value"))


def _english(value: str = "value"):
    return F.from_json(value, _NAMED)["name"]["en-us"]


def type_names(constants: DataFrame) -> DataFrame:
    """``(code, type_name)``; entries without an English name are dropped."""
    rows = _section(constants, "accommodation_types").select(F.col("key").alias("code"), _english().alias("type_name"))
    return rows.where(F.col("type_name") != "")


def facilities(constants: DataFrame) -> DataFrame:
    """``(facility_id, facility_name, category)``, names and categories NULL where unknown."""
    items = _section(constants, "accommodation_facilities").select(
        F.col("key").alias("facility_id"),
        blank_to_null(_english()).alias("facility_name"),
        F.from_json("value", _NAMED)["facility_type"].alias("type_id"),
    )
    kinds = _section(constants, "facility_types").select(F.col("key").alias("type_id"), blank_to_null(_english()).alias("category"))
    return items.join(kinds, "type_id", "left").select("facility_id", "facility_name", "category")


def _section(constants: DataFrame, name: str) -> DataFrame:
    body = F.get_json_object("value", f"$.{name}")
    return constants.select(F.explode(F.from_json(body, "map<string,string>")).alias("key", "value"))


def type_categories(documents: DataFrame) -> DataFrame:
    """``(type_name, category)``; rows that are no objects or carry no name are dropped, the last one wins."""
    mapped = F.from_json(F.get_json_object("value", "$.property_type_mapping.mapped"), "array<string>")
    rows = documents.select(F.posexplode(mapped).alias("_pos", "row")).select(
        F.get_json_object("row", "$.property_type_name").alias("type_name"),
        F.coalesce(F.get_json_object("row", "$.group_name"), F.lit("")).alias("category"),
        "_pos",
    )
    return keep_last(rows.where(F.col("type_name") != ""), ["type_name"], ["_pos"]).drop("_pos")


def countries(codes: DataFrame) -> DataFrame:
    """``(country_key, country)`` of ``(key, value)`` with the code in lower case."""
    rows = codes.select(F.lower("key").alias("country_key"), F.col("value").alias("country"), "key")
    return keep_last(rows, ["country_key"], ["key"]).drop("key")


def cities(documents: DataFrame) -> DataFrame:
    """``(country_key, city_code, city)`` of every per-country file; the country is the folder name."""
    row = "array<struct<city_code: string, city: string>>"
    rows = documents.select(
        F.element_at(F.split("_file", "/"), -2).alias("country_key"),
        F.posexplode(F.from_json("value", row)).alias("_pos", "r"),
    ).select("country_key", F.col("r.city_code").alias("city_code"), F.coalesce("r.city", F.lit("")).alias("city"), "_pos")
    return keep_last(rows.where(F.col("city_code").isNotNull()), ["country_key", "city_code"], ["_pos"]).drop("_pos")


@dataclass(frozen=True)
class Lookups:
    """The lookups the cleaning step joins, each broadcast if its checked size allows."""

    types: DataFrame
    categories: DataFrame
    countries: DataFrame
    cities: DataFrame
    facilities: DataFrame

    def release(self) -> None:
        for df in (self.types, self.categories, self.countries, self.cities, self.facilities):
            df.unpersist()


def load_lookups(spark: SparkSession, root: str) -> Lookups:
    """Read, cache and size-check the static files below ``root``; a call reads the files as they are then."""
    constants = _documents(spark, f"{root}/static/constants.json")
    frames = (
        type_names(constants),
        type_categories(_documents(spark, f"{root}/static/property_type_categories.json")),
        countries(static_map(spark, root, "static/location_mapping/countries.json")),
        cities(_documents(spark, f"{root}/static/location_mapping/*/city.json")),
        facilities(constants),
    )
    for df in frames:
        # Spark knows cached data by its plan, which names files and not their contents: drop what an earlier call left.
        df.unpersist(blocking=True)
    return Lookups(*(broadcast_if_small(df.cache()) for df in frames))


def location_names(spark: SparkSession, root: str, country: str, kind: str) -> DataFrame:
    """One country's ``(code, name)`` file of a location kind (city, district, landmark, region).

    The file is a list of rows with ``<kind>_code`` and ``<kind>`` or a flat map from code to name.
    """
    path = f"{root}/static/location_mapping/{country.lower()}/{kind}.json"
    if not exists(spark, path):
        return spark.createDataFrame([], "code string, name string")
    text = _documents(spark, path)
    is_list = F.ltrim("value").startswith("[")
    listed = text.where(is_list).select(F.explode(F.from_json("value", "array<string>")).alias("r"))
    listed = listed.select(F.get_json_object("r", f"$.{kind}_code").alias("code"), F.get_json_object("r", f"$.{kind}").alias("name"))
    mapped = text.where(~is_list).select(F.explode(F.from_json("value", "map<string,string>")).alias("code", "name"))
    return listed.unionByName(mapped).where(F.col("code").isNotNull())
