"""Registry of queries over the supplied tables, each beside the SQL that gives the same rows.

The supplied tables hold no listings. ``listing_rows`` derives the listing table from ``customer``,
``nation`` and ``region`` by plain arithmetic, over every row, so that SQL can do the same.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.functions.geo import point_text
from lodgeframe.functions.text import slugify
from lodgeframe.operators.cleaning import policy_json, property_flags_json
from lodgeframe.sources.tables import VersionedTable, evolve

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is checked by tests on small fixtures only."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, rows: int = 1_000) -> DataFrame:
    """The same rows dealt over all cores, where a small file costs much time a row; about ``rows`` or more in a task."""
    spark = df.sparkSession
    n = df.count()
    return df.repartition(max(1, min(n // rows, 3 * spark.sparkContext.defaultParallelism), n // 50_000))


def scratch(spark: SparkSession) -> str:
    """A new folder for files a query writes: under the shared one the cluster names, else a local one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/queries/{os.urandom(8).hex()}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="lodgeframe-")


def _derived_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    # A file of a few MB is one split or two; each of its rows becomes a listing of 43 columns.
    c = spread(c)
    joined = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    k = F.col("c_custkey")
    key = k.cast("string")

    def null_every(m: int, value):
        return F.when(k % m != 0, value)

    image = F.concat(F.lit("https://img.example/"), key)
    minimum_age = F.when(k % 4 != 0, (F.lit(14) + k % 6).cast("int"))
    allowed = F.when(k % 3 == 0, "yes").when(k % 3 == 1, "no")
    information = F.when(k % 5 == 0, "We are eco-friendly").otherwise("Please do not smoke")
    synced = F.timestamp_seconds(F.lit(1704067200) + k * 60)
    derived = joined.select(
        F.concat(F.lit("BC-"), key).alias("external_id"),
        F.lit(11).alias("feed"),
        key.alias("feed_provider_id"),
        F.concat(F.lit("https://stays.example/"), key).alias("feed_provider_url"),
        F.col("c_name").alias("property_name"),
        slugify(F.col("c_name")).alias("property_slug"),
        F.col("c_mktsegment").alias("property_type"),
        F.when(k % 2 == 0, "House").otherwise("Apartment").alias("property_type_category"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.lower("n_name").alias("country_code"),
        F.concat_ws(", ", "n_name", "r_name").alias("location_display"),
        F.col("c_nationkey").cast("string").alias("partner_location_id"),
        point_text(45 + (k * 53 % 3001) / 10000, (k * 37 % 4001 - 2000) / 10000).alias("latlon"),
        F.lit("en-us").alias("language"),
        null_every(9, 1 + k % 5).cast("int").alias("star_rating"),
        ((k % 1000) / 100).cast("decimal(4,2)").alias("review_score"),
        ((k % 500) / 100).cast("decimal(4,2)").alias("review_score_general"),
        (k % 300).cast("int").alias("number_of_review"),
        (k % 5).cast("int").alias("bedroom_count"),
        (k % 3).cast("int").alias("bathroom_count"),
        (k % 12).cast("int").alias("occupancy"),
        (k % 12).cast("int").alias("max_occupancy"),
        F.lit("USD").alias("currency"),
        null_every(11, F.col("c_acctbal")).cast("decimal(10,2)").alias("price"),
        (1 + k % 7).cast("int").alias("min_stay"),
        F.when(k % 4 == 0, "").otherwise(F.concat(image, F.lit("/0.jpg"))).alias("feature_image"),
        F.when(k % 6 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(image, F.lit("/0.jpg")), F.concat(image, F.lit("/1.jpg?a=1&b=2"))))
        .alias("images"),
        (k % 2 == 0).alias("family_friendly"),
        (k % 12 >= 6).alias("group_friendly"),
        F.array("c_mktsegment", "n_name").alias("amenities"),
        F.array("r_name").alias("amenity_categories"),
        policy_json(allowed, minimum_age, k % 4 == 1).alias("policy"),
        property_flags_json((k % 7 == 0).cast("string"), (k % 8 == 0).cast("string"), information, minimum_age).alias("property_flags"),
        information.alias("other_policy"),
        F.lit("[]").alias("feature_summary"),
        F.concat(F.lit("A "), F.lower("c_mktsegment"), F.lit(" home in "), F.col("n_name")).alias("property_description"),
        (k % 10 != 3).alias("is_published"),
        F.lit("{}").alias("raw_data"),
        synced.alias("source_created_at"),
        synced.alias("source_updated_at"),
        synced.alias("last_synced_at"),
        synced.alias("created_at"),
    )
    return evolve(derived, schemas.LISTING_SCHEMA).select(*schemas.LISTING_COLUMNS)


def listing_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Listing table derived from customers, written once; the SQL form is ``LISTING_SQL``."""
    listings = VersionedTable(spark, f"{scratch(spark)}/listings")
    listings.write(_derived_listings(spark, sf_dir))
    return listings


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``listing_table`` as read back, so that a query scans a table as it would in use."""
    return listing_table(spark, sf_dir).read()


# The columns of ``listing_rows`` that the oracles use. Policies and flags are given as their parts.
LISTING_SQL = """
listing AS (
  SELECT c_custkey AS k, 'BC-' || c_custkey AS external_id, 11 AS feed, CAST(c_custkey AS VARCHAR) AS feed_provider_id,
    'https://stays.example/' || c_custkey AS feed_provider_url, c_name AS property_name,
    trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') AS property_slug,
    c_mktsegment AS property_type, CASE WHEN c_custkey % 2 = 0 THEN 'House' ELSE 'Apartment' END AS property_type_category,
    n_name AS city, r_name AS country, lower(n_name) AS country_code, concat_ws(', ', n_name, r_name) AS location_display,
    CAST(c_nationkey AS VARCHAR) AS partner_location_id,
    45 + (c_custkey * 53 % 3001) / 10000 AS lat, (c_custkey * 37 % 4001 - 2000) / 10000 AS lon,
    CASE WHEN c_custkey % 9 <> 0 THEN CAST(1 + c_custkey % 5 AS INTEGER) END AS star_rating,
    CAST((c_custkey % 500) / 100 AS DECIMAL(4,2)) AS review_score_general,
    CAST(c_custkey % 300 AS INTEGER) AS number_of_review, CAST(c_custkey % 5 AS INTEGER) AS bedroom_count,
    CAST(c_custkey % 3 AS INTEGER) AS bathroom_count, CAST(c_custkey % 12 AS INTEGER) AS occupancy,
    CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_acctbal AS DECIMAL(10,2)) END AS price,
    CAST(1 + c_custkey % 7 AS INTEGER) AS min_stay,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'https://img.example/' || c_custkey || '/0.jpg' END AS feature_image,
    CASE WHEN c_custkey % 6 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['https://img.example/' || c_custkey || '/0.jpg',
      'https://img.example/' || c_custkey || '/1.jpg?a=1&b=2'] END AS images,
    c_custkey % 2 = 0 AS family_friendly, c_custkey % 12 >= 6 AS group_friendly,
    [c_mktsegment, n_name] AS amenities, [r_name] AS amenity_categories,
    CASE WHEN c_custkey % 3 = 0 THEN 'yes' WHEN c_custkey % 3 = 1 THEN 'no' END AS pets,
    CASE WHEN c_custkey % 4 <> 0 THEN CAST(14 + c_custkey % 6 AS INTEGER) END AS min_age,
    c_custkey % 4 = 1 AS free_cancellation, c_custkey % 7 = 0 AS work_friendly, c_custkey % 8 = 0 AS long_stay,
    c_custkey % 5 = 0 AS eco,
    'A ' || lower(c_mktsegment) || ' home in ' || n_name AS property_description, c_custkey % 10 <> 3 AS is_published,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS synced
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)
"""

HAVERSINE_SQL = (
    "2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2)"
    " + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"
)


def haversine_sql(a: str, b: str) -> str:
    return HAVERSINE_SQL.format(a=a, b=b)
