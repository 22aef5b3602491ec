"""Cleaning expressions and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.functions.geo import any_point, point_text
from lodgeframe.functions.text import iso_timestamp, parse_iso_timestamp, slugify, strip_html, to_decimal, to_int, trimmed_or_blank
from lodgeframe.operators.cleaning import (
    adults_only,
    checkin_age_text,
    eco_friendly,
    facility_columns,
    feature_image_and_images,
    group_friendly,
    pets_policy_text,
    resolve_places,
    resolve_types,
)
from lodgeframe.queries.base import query, spread, table
from lodgeframe.sources import lookups

_STRIP_SQL = r"trim(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"


@query("clean_description", f"SELECT page_id, {_STRIP_SQL.format('html')} AS text FROM pages")
def clean_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text of HTML."""
    return table(spark, sf_dir, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


@query(
    "coerce_numbers",
    """WITH e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN '-' || CAST(value AS VARCHAR)
        WHEN 2 THEN event_type WHEN 3 THEN '' WHEN 4 THEN json_extract_string(props, '$.k') || '.0' END AS raw FROM events)
    SELECT event_id, CAST(trunc(TRY_CAST(nullif(raw, '') AS DOUBLE)) AS INTEGER) AS as_int,
      CAST(TRY_CAST(nullif(raw, '') AS DECIMAL(4,1)) AS DOUBLE) AS as_decimal FROM e""",
)
def coerce_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from text that may be no number: truncated integers, rounded decimals, else NULL."""
    case = F.col("event_id") % 6
    value = F.col("value").cast("string")
    raw = (
        F.when(case == 0, value)
        .when(case == 1, F.concat(F.lit("-"), value))
        .when(case == 2, F.col("event_type"))
        .when(case == 3, "")
        .when(case == 4, F.concat(F.get_json_object("props", "$.k"), F.lit(".0")))
    )
    events = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return events.select(
        "event_id", to_int(F.col("raw")).alias("as_int"), to_decimal(F.col("raw"), 4, 1).cast("double").alias("as_decimal")
    )


_ORDER_AGE_SQL = "CASE WHEN o_orderkey % 4 <> 0 THEN CAST(14 + o_orderkey % 8 AS INTEGER) END"


@query(
    "policy_flags",
    f"""WITH o AS (SELECT o_orderkey, {_ORDER_AGE_SQL} AS age, CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' END AS pets,
        o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN ' ECO Friendly stay' WHEN o_orderkey % 3 = 1 THEN ' eco-friendly' ELSE ' eco' END AS info,
        CASE WHEN o_custkey % 5 <> 0 THEN o_custkey % 9 END AS guests FROM orders)
    SELECT o_orderkey, CASE pets WHEN 'no' THEN 'Pets are not allowed' WHEN 'yes' THEN 'Pets are allowed' ELSE 'Pet policy not specified' END AS pets_text,
      CASE WHEN age >= 18 THEN 'Only adults are allowed to check in' ELSE 'Anyone can check in' END AS age_text,
      coalesce(age >= 18, false) AS adults_only, lower(info) LIKE '%eco friendly%' OR lower(info) LIKE '%eco-friendly%' AS eco,
      coalesce(guests, 0) >= 6 AS for_groups FROM o""",
)
def policy_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy texts and flags."""
    k = F.col("o_orderkey")
    age = F.when(k % 4 != 0, (14 + k % 8)).cast("int")
    pets = F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no")
    tail = F.when(k % 3 == 0, " ECO Friendly stay").when(k % 3 == 1, " eco-friendly").otherwise(" eco")
    guests = F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey") % 9).cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        pets_policy_text(pets).alias("pets_text"),
        checkin_age_text(age).alias("age_text"),
        adults_only(age).alias("adults_only"),
        eco_friendly(F.concat("o_orderpriority", tail)).alias("eco"),
        group_friendly(guests).alias("for_groups"),
    )


@query(
    "slug",
    """SELECT doc_id AS id, trim(regexp_replace(regexp_replace(lower(strip_accents(replace(replace(replace(replace(text, 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae'), 'Œ', 'OE'))),
      '([0-9]),([0-9])', '\\1\\2', 'g'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents
    UNION ALL SELECT p_partkey, trim(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') FROM part""",
)
def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of whole texts in four languages and of short names."""
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_brand").alias("t"))
    return spread(texts.unionByName(names), 100).select("id", slugify(F.col("t")).alias("slug"))


@query(
    "type_lookup",
    """SELECT c_custkey, coalesce(n_name, '') AS property_type, coalesce(r_name, '') AS property_type_category
    FROM customer LEFT JOIN nation ON CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN -1 ELSE c_nationkey END = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def type_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code to name to group, with missing and unknown codes."""
    k = F.col("c_custkey")
    code = F.when(k % 6 == 0, None).when(k % 7 == 0, -1).otherwise(F.col("c_nationkey")).cast("string")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    types = nation.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("type_name"))
    groups = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("type_name"), F.col("r_name").alias("category")
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", code.alias("type_code"))
    return resolve_types(rows, types, groups).select("c_custkey", "property_type", "property_type_category")


@query(
    "place_lookup",
    """SELECT c_custkey, coalesce(CASE WHEN c_custkey % 8 <> 0 THEN n.n_name END, '') AS country,
      coalesce(CASE WHEN c_custkey % 8 <> 0 THEN s_name END, '') AS city
    FROM customer LEFT JOIN nation n ON c_nationkey = n_nationkey
    LEFT JOIN supplier ON s_suppkey = c_custkey AND s_nationkey = c_nationkey""",
)
def place_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country by code in any case, city by country and code; '' where unknown."""
    k = F.col("c_custkey")
    code = F.concat(F.when(k % 2 == 0, "N").otherwise("n"), F.col("c_nationkey").cast("string"))
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 8 == 0, "").otherwise(code).alias("country_code"), k.cast("string").alias("city_code")
    )
    key = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    countries = table(spark, sf_dir, "nation").select(key.alias("country_key"), F.col("n_name").alias("country"))
    cities = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("country_key"),
        F.col("s_suppkey").cast("string").alias("city_code"),
        F.col("s_name").alias("city"),
    )
    return resolve_places(rows, countries, cities).select("c_custkey", "country", "city")


def _facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    pos = F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("pos")
    name = F.when(F.col("l_partkey") % 9 != 0, F.col("p_brand")).alias("facility_name")
    category = F.when(F.col("l_partkey") % 10 != 0, F.col("p_type")).alias("category")
    return facility_columns(line.join(part, line.l_partkey == part.p_partkey).select("l_orderkey", pos, name, category), ["l_orderkey"])


_FACILITY_SQL = """
WITH f AS (
  SELECT l_orderkey, CASE WHEN l_partkey % 9 <> 0 THEN p_brand END AS name, CASE WHEN l_partkey % 10 <> 0 THEN p_type END AS category,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


@query(
    "amenities",
    f"""{_FACILITY_SQL}, c AS (SELECT l_orderkey, category, min(pos) AS first_pos FROM f WHERE category IS NOT NULL GROUP BY ALL)
    SELECT f.l_orderkey, coalesce(string_agg(name, '|' ORDER BY pos), '') AS amenities,
      coalesce(any_value((SELECT string_agg(category, '|' ORDER BY first_pos) FROM c WHERE c.l_orderkey = f.l_orderkey)), '') AS categories
    FROM f GROUP BY f.l_orderkey""",
)
def amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amenity names in order, distinct categories in order of first appearance."""
    return _facilities(spark, sf_dir).select(
        "l_orderkey", F.array_join("amenities", "|").alias("amenities"), F.array_join("amenity_categories", "|").alias("categories")
    )


@query(
    "feature_summary",
    f"""{_FACILITY_SQL}, g AS (SELECT l_orderkey, category, min(pos) AS first_pos, string_agg(name, chr(10) ORDER BY pos) AS names
      FROM f WHERE name IS NOT NULL AND category IS NOT NULL GROUP BY ALL)
    SELECT l_orderkey, string_agg(category || '=' || names, ';' ORDER BY first_pos) AS summary FROM g GROUP BY l_orderkey""",
)
def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names grouped by category, read back from the JSON text."""
    items = F.from_json("feature_summary", "array<struct<name: string, description: string>>")
    summary = F.array_join(F.transform(items, lambda i: F.concat(i["name"], F.lit("="), i["description"])), ";")
    return _facilities(spark, sf_dir).select("l_orderkey", summary.alias("summary")).where("summary <> ''")


@query(
    "image_choice",
    """WITH p AS (SELECT l_orderkey, 'u' || l_partkey || '-' || l_suppkey AS url, l_returnflag = 'R' AS main, l_linestatus = 'O' AS has_url,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS pos FROM lineitem),
    m AS (SELECT l_orderkey, arg_min(CASE WHEN has_url THEN url ELSE '' END, pos) FILTER (WHERE main) AS main_url,
        arg_min(url, pos) FILTER (WHERE has_url) AS first_url, coalesce(string_agg(url, ' ' ORDER BY pos) FILTER (WHERE has_url), '') AS images
      FROM p GROUP BY l_orderkey)
    SELECT l_orderkey, coalesce(nullif(main_url, ''), first_url, '') AS feature_image, images FROM m""",
)
def image_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main photo, else the first with a URL; all URLs in order."""
    url = F.concat(F.lit("u"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"))
    photo = F.struct(
        F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("pos"),
        (F.col("l_returnflag") == "R").cast("string").alias("main_photo"),
        F.struct(F.when(F.col("l_linestatus") == "O", url).otherwise("").alias("standard")).alias("url"),
    )
    photos = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(photo)).alias("photos"))
    feature, images = feature_image_and_images(F.col("photos"))
    return photos.select("l_orderkey", feature.alias("feature_image"), F.array_join(images, " ").alias("images"))


@query(
    "point_text",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN 'SRID=4326;POINT (' || CAST((c_custkey * 37 % 4001 - 2000) / 1000 AS VARCHAR) || ' '
      || CAST(45 + (c_custkey * 53 % 3001) / 10000 AS VARCHAR) || ')' END AS point FROM customer""",
)
def point_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EWKT text from numbers given as text; junk coordinates give NULL."""
    k = F.col("c_custkey")
    lat = (45 + (k * 53 % 3001) / 10000).cast("string")
    lon = F.when(k % 5 == 0, F.when(k % 2 == 0, "west")).otherwise(((k * 37 % 4001 - 2000) / 1000).cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", point_text(lat, lon).alias("point"))


@query(
    "point_parse",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4 THEN (o_custkey % 181 - 90) / 2 END AS lat,
      CASE WHEN o_orderkey % 6 < 4 THEN (o_custkey % 361 - 180) / 2 END AS lon FROM orders""",
)
def point_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points from EWKT text and three JSON shapes; two other shapes give NULL."""
    k, c = F.col("o_orderkey") % 6, F.col("o_custkey")
    lat, lon = ((c % 181 - 90) / 2).cast("string"), ((c % 361 - 180) / 2).cast("string")
    shapes = [
        F.format_string("SRID=4326;POINT (%s %s)", lon, lat),
        F.format_string('{"lat": %s, "lon": "%s"}', lat, lon),
        F.format_string('{"latitude": "%s", "longitude": %s}', lat, lon),
        F.format_string('{"coordinates": [%s, %s]}', lon, lat),
        F.format_string('{"coordinates": [%s, %s, 0]}', lon, lat),
        F.format_string("%s,%s", lat, lon),
    ]
    text = F.array(*shapes)[k.cast("int")]
    point = any_point(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", point["lat"].alias("lat"), point["lon"].alias("lon"))


@query(
    "iso_timestamps",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 <> 0
      THEN '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') ELSE '' END
      WHEN event_id % 3 = 1 THEN strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') END AS parsed FROM events""",
)
def iso_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO-8601 text with and without offset to timestamps and back; other text is NULL."""
    case = F.col("event_id") % 3
    raw = (
        F.when(case == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(case == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-07:00")))
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select("event_id", iso_timestamp(parse_iso_timestamp(raw)).alias("parsed"))


@query(
    "blank_texts",
    """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN trim(text, chr(32) || chr(9) || chr(10) || chr(160)) ELSE '' END AS text FROM conversations""",
)
def blank_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed text with Unicode blanks; missing text is empty."""
    padded = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" \t\n "), F.col("text"), F.lit("  \n")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", trimmed_or_blank(padded).alias("text"))


@query(
    "lookup_parse",
    """SELECT 'type' AS kind, CAST(p_partkey AS VARCHAR) AS code, p_type AS name, '' AS category FROM part WHERE p_partkey % 4 <> 0
    UNION ALL SELECT 'facility', 'f' || p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_name END, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END FROM part
    UNION ALL SELECT 'category', p_name || ' ' || p_partkey, CASE WHEN p_partkey % 6 <> 0 THEN p_brand ELSE '' END, '' FROM part
    UNION ALL SELECT 'country', lower(p_name) || p_partkey, p_brand, '' FROM part
    UNION ALL SELECT 'map', 'k', CAST(json_extract_string(props, '$.k') AS VARCHAR), '' FROM events""",
)
def lookup_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup files' JSON shapes, one small document per row, read by the lookup parsers."""
    part, k = spread(table(spark, sf_dir, "part")), F.col("p_partkey")
    key = k.cast("string")

    def obj(*pairs):
        return F.concat(F.lit("{"), *pairs, F.lit("}"))

    def quoted(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    def named(c):
        return F.concat(F.lit('{"name": {"en-us": "'), c, F.lit('"}'))

    constants = part.select(
        obj(
            F.lit('"accommodation_types": {'), quoted(key), F.lit(": "),
            F.when(k % 4 == 0, '{"name": {}').otherwise(named(F.col("p_type"))), F.lit("}}"),
            F.lit(', "accommodation_facilities": {'), quoted(F.concat(F.lit("f"), key)), F.lit(": "),
            named(F.when(k % 5 == 0, "").otherwise(F.col("p_name"))), F.lit(', "facility_type": '), key, F.lit("}}"),
            F.lit(', "facility_types": {'), F.when(k % 3 == 0, '"none').otherwise(F.concat(F.lit('"'), key)), F.lit('": '),
            named(F.col("p_brand")), F.lit("}}"),
        ).alias("value")
    )
    row = obj(F.lit('"property_type_name": '), quoted(F.concat_ws(" ", "p_name", key)),
              F.when(k % 6 == 0, "").otherwise(F.concat(F.lit(', "group_name": '), quoted(F.col("p_brand")))))
    mapped = F.concat(F.lit('{"property_type_mapping": {"mapped": [true, {"group_name": "unnamed"}, '), row, F.lit("]}}"))
    by_code = obj(quoted(F.concat(F.upper("p_name"), key)), F.lit(": "), quoted(F.col("p_brand")))
    codes = part.select(F.explode(F.from_json(by_code, "map<string,string>")).alias("key", "value"))
    props = spread(table(spark, sf_dir, "events").select("props")).select(F.explode(F.from_json("props", "map<string,string>")).alias("code", "name"))

    def kind(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
        code, label, *category = columns
        return df.select(
            F.lit(name).alias("kind"), F.col(code).alias("code"), F.col(label).alias("name"),
            (F.col(category[0]) if category else F.lit("")).alias("category"),
        )

    return (
        kind(lookups.type_names(constants), "type", ["code", "type_name"])
        .unionByName(kind(lookups.facilities(constants), "facility", ["facility_id", "facility_name", "category"]))
        .unionByName(kind(lookups.type_categories(part.select(mapped.alias("value"))), "category", ["type_name", "category"]))
        .unionByName(kind(lookups.countries(codes), "country", ["country_key", "country"]))
        .unionByName(kind(props, "map", ["code", "name"]))
    )
