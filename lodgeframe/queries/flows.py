"""Whole flows over files that Spark writes from the supplied tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.operators.documents import search_documents
from lodgeframe.plans.daily_sync import sync_day
from lodgeframe.queries.base import LISTING_SQL, listing_table, query, scratch, table
from lodgeframe.sinks.keyed_store import KeyedStore
from lodgeframe.sources.partner import partner_rows
from lodgeframe.sources.paths import matches, rename, rename_all
from lodgeframe.sources.tables import VersionedTable
from lodgeframe.streaming.change_events import run_change_stream

DAY = "20240102"


def _json_lists(rows: DataFrame, folder: str, per_file: int = 500) -> None:
    """Write ``value`` (JSON text) as files that each hold one list of at most ``per_file`` records."""
    listed = rows.groupBy("chunk").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("value"))
    listed.repartition("chunk").select("value").write.option("maxRecordsPerFile", 1).text(folder)


def _as_json_files(spark: SparkSession, folder: str, name: str) -> None:
    """Give the part files of a text write the names feed files have."""
    rename_all(spark, {path: f"{folder}/{name}_{i:05d}.json" for i, path in enumerate(matches(spark, f"{folder}/part-*"))})


def write_feeds(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Feed files of one day: customers as listing records, orders as search records, events as changelog."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    room = F.struct(
        F.struct((k % 5).cast("double").alias("bedrooms"), (k % 3).cast("double").alias("bathrooms")).alias("number_of_rooms"),
        F.struct((k % 12).alias("total_guests"), F.when(k % 2 == 0, 1).alias("children")).alias("maximum_occupancy"),
    )
    record = F.struct(
        k.alias("id"),
        F.create_map(F.lit("en-us"), F.concat(F.lit(" "), "c_name")).alias("name"),
        F.col("c_nationkey").alias("accommodation_type"),
        F.when(k % 10 != 3, "open").otherwise("closed_temporarily").alias("accommodation_status"),
        F.struct(
            F.lit("FR").alias("country"),
            F.col("c_nationkey").alias("city"),
            F.struct(
                (45 + (k * 53 % 3001) / 10000).alias("latitude"), ((k * 37 % 4001 - 2000) / 10000).cast("string").alias("longitude")
            ).alias("coordinates"),
        ).alias("location"),
        F.struct((k % 5).cast("double").alias("stars"), ((k % 20) / 2).alias("review_score")).alias("rating"),
        F.array(room).alias("rooms"),
        F.array(F.struct((k % 25).alias("id")), F.struct(((k + 1) % 25).alias("id")), F.struct(F.lit(99).alias("id"))).alias("facilities"),
        F.col("c_mktsegment").alias("unknown_key"),
    )
    records = c.select((k % 2).alias("bucket"), F.floor(k / 500).alias("chunk"), F.to_json(record).alias("value"))
    for order, bucket in enumerate(("changed", "opened")):
        folder = f"{root}/accommodation_details/{DAY}/{bucket}"
        # Every record arrives as changed; those of odd customers arrive again as opened.
        _json_lists(records if bucket == "changed" else records.where("bucket = 1"), folder)
        _as_json_files(spark, folder, f"details_{bucket}")
    o = table(spark, sf_dir, "orders")
    offer = F.struct(
        F.col("o_custkey").alias("id"),
        F.struct(F.lit("EUR").alias("booker")).alias("currency"),
        F.struct(F.struct(F.col("o_totalprice").alias("booker_currency")).alias("base")).alias("price"),
    )
    latest = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("o_totalprice"))
    offers = latest.select(F.floor(F.col("o_custkey") / 500).alias("chunk"), F.to_json(offer).alias("value"))
    folder = f"{root}/search/{DAY}/changed"
    _json_lists(offers, folder)
    _as_json_files(spark, folder, "search_changed")
    events = table(spark, sf_dir, "events")
    for kind, event in (("changed", "view"), ("opened", "signup")):
        ids = events.where(F.col("event_type") == event).select("user_id").distinct()
        listed = ids.agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("user_id")), ","), F.lit("]")).alias("value"))
        target = f"{root}/changelog/{DAY}"
        listed.coalesce(1).write.mode("append").text(f"{target}/{kind}")
        _as_json_files(spark, f"{target}/{kind}", f"day_{kind}_20231231")
        rename(spark, matches(spark, f"{target}/{kind}/*.json")[0], f"{target}/day_{kind}_20231231.json")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey").cast("string")

    def named(c):
        return F.create_map(F.lit("en-us"), c)

    def section(df: DataFrame, key, value, name: str):
        return df.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias(name))

    types = section(n, key, F.struct(named(F.col("n_name")).alias("name")), "accommodation_types")
    facility = F.struct(named(F.col("n_name")).alias("name"), F.col("n_regionkey").alias("facility_type"))
    facilities = section(n, key, facility, "accommodation_facilities")
    kinds = section(r, F.col("r_regionkey").cast("string"), F.struct(named(F.col("r_name")).alias("name")), "facility_types")
    constants = types.crossJoin(facilities).crossJoin(kinds)  # one row each
    mapped = n.join(r, n.n_regionkey == r.r_regionkey).agg(
        F.collect_list(F.struct(F.col("n_name").alias("property_type_name"), F.col("r_name").alias("group_name"))).alias("mapped")
    )
    documents = {
        "static/constants": constants.select(F.to_json(F.struct("*")).alias("value")),
        "static/property_type_categories": mapped.select(F.to_json(F.struct(F.struct("mapped").alias("property_type_mapping"))).alias("value")),
        "static/location_mapping/countries": n.limit(1).select(F.lit('{"FR": "France"}').alias("value")),
        "static/location_mapping/fr/city": n.agg(
            F.to_json(F.collect_list(F.struct(F.col("n_nationkey").alias("city_code"), F.col("n_name").alias("city")))).alias("value")
        ),
    }
    for name, document in documents.items():
        document.coalesce(1).write.text(f"{root}/_staged/{name}")
        rename(spark, matches(spark, f"{root}/_staged/{name}/part-*")[0], f"{root}/{name}.json")


_SYNC_COLUMNS = (
    "feed_provider_id external_id property_name property_slug property_type property_type_category city country latlon star_rating "
    "bedroom_count occupancy currency min_stay family_friendly group_friendly is_published"
).split()


@query(
    "daily_sync",
    f"""WITH {LISTING_SQL}, ids AS (SELECT user_id FROM events WHERE event_type IN ('view', 'signup')),
    offer AS (SELECT o_custkey, max(o_totalprice) AS price FROM orders GROUP BY o_custkey),
    f AS (SELECT i, CAST(i AS VARCHAR) AS pos FROM range(3) t(i))
    SELECT feed_provider_id, external_id, property_name, property_slug, n.n_name AS property_type, r.r_name AS property_type_category, n.n_name AS city,
      'France' AS country, 'SRID=4326;POINT (' || CAST(lon AS VARCHAR) || ' ' || CAST(lat AS VARCHAR) || ')' AS latlon,
      CAST(l.k % 5 AS INTEGER) AS star_rating, bedroom_count, occupancy, CASE WHEN offer.price IS NULL THEN 'USD' ELSE 'EUR' END AS currency,
      CAST(1 AS INTEGER) AS min_stay, family_friendly, occupancy >= 6 AS group_friendly, is_published,
      CAST((l.k % 20) / 2 AS DOUBLE) AS review_score, CAST(CAST((l.k % 20) / 4 AS DECIMAL(4,2)) AS DOUBLE) AS review_score_general,
      CAST(CAST(offer.price AS DECIMAL(10,2)) AS DOUBLE) AS price, a.n_name || '|' || b.n_name AS amenities,
      CASE WHEN a.n_regionkey = b.n_regionkey THEN ra.r_name ELSE ra.r_name || '|' || rb.r_name END AS categories, l.property_type AS unknown_key
    FROM listing l JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = partner_location_id JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN offer ON o_custkey = l.k JOIN nation a ON a.n_nationkey = l.k % 25 JOIN nation b ON b.n_nationkey = (l.k + 1) % 25
    JOIN region ra ON a.n_regionkey = ra.r_regionkey JOIN region rb ON b.n_regionkey = rb.r_regionkey
    WHERE l.k IN (SELECT user_id FROM ids)""",
)
def daily_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds, changelog and lookups of one day, cleaned and merged into an empty table, then merged again."""
    root = scratch(spark)
    write_feeds(spark, sf_dir, f"{root}/feeds")
    listings = VersionedTable(spark, f"{root}/table")
    for hour in (1, 2):
        sync_day(spark, f"{root}/feeds", listings, DAY, datetime(2024, 1, 2, hour, tzinfo=timezone.utc), f"{root}/events")
    return listings.read().select(
        *_SYNC_COLUMNS,
        *[F.col(c).cast("double").alias(c) for c in ("review_score", "review_score_general", "price")],
        F.array_join("amenities", "|").alias("amenities"),
        F.array_join("amenity_categories", "|").alias("categories"),
        F.get_json_object("raw_data", "$.unknown_key").alias("unknown_key"),
    )


@query(
    "sync_rejects",
    """SELECT 'file is not valid JSON' AS reason, CAST(NULL AS VARCHAR) AS raw_data FROM (SELECT DISTINCT c_custkey // 500 AS chunk FROM customer) WHERE chunk % 3 = 0
    UNION ALL SELECT 'record is not an object', '"' || c_name || '"' FROM customer WHERE c_custkey // 500 % 3 = 1 AND c_custkey % 10 = 0""",
)
def sync_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a sync whose files are in part cut off and in part mixed with texts that are no records."""
    root = scratch(spark)
    k = F.col("c_custkey")
    chunk = F.floor(k / 500)
    text = (chunk % 3 == 1) & (k % 10 == 0)
    value = F.when(text, F.concat(F.lit('"'), "c_name", F.lit('"'))).otherwise(F.to_json(F.struct(k.alias("id"))))
    rows = table(spark, sf_dir, "customer").select(chunk.alias("chunk"), value.alias("value"))
    end = F.when(F.col("chunk") % 3 == 0, "").otherwise("]")
    listed = rows.groupBy("chunk").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",")).alias("value"))
    folder = f"{root}/feeds/accommodation_details/{DAY}/changed"
    listed.select(F.concat("value", end).alias("value")).repartition(4).write.option("maxRecordsPerFile", 1).text(folder)
    _as_json_files(spark, folder, "details")
    listings = VersionedTable(spark, f"{root}/table")
    sync_day(spark, f"{root}/feeds", listings, DAY, datetime(2024, 1, 2, tzinfo=timezone.utc), rejects_root=f"{root}/rejects")
    kept = spark.read.schema("file string, reason string, raw_data string").json(f"{root}/rejects/date={DAY}")
    return kept.select("reason", "raw_data")


_STREAM_SQL = f"""WITH {LISTING_SQL} SELECT external_id AS id, property_name, city, strftime(synced, '%Y-%m-%dT%H:%M:%S') AS updated_at
    FROM listing WHERE k IN (SELECT user_id FROM events)"""


def _streamed(spark: SparkSession, sf_dir: str, root: str, runs: int) -> DataFrame:
    """Search documents kept by the stream from change events, some of them malformed; every run reads all events anew."""
    events = table(spark, sf_dir, "events")
    message = F.struct(F.date_format("ts", "yyyyMMdd").alias("date"), F.array(F.col("user_id").cast("string")).alias("feed_provider_ids"))
    bad = F.concat(F.lit("{broken "), "event_type")
    lines = events.select(F.to_json(message).alias("value")).unionByName(events.select(bad.alias("value")))
    lines.repartition(4).write.text(f"{root}/events")
    # The listing table is written once; every batch reads its newest version anew.
    listings = listing_table(spark, sf_dir)
    store = KeyedStore(spark, f"{root}/documents", ["id"], search_documents(listings.read()).schema, buckets=8)
    for run in range(runs):
        stream = run_change_stream(
            spark, f"{root}/events", listings.read, store, f"{root}/rejects", f"{root}/checkpoint-{run}", max_files=2
        )
        stream.awaitTermination()
    return store.read().select("id", "property_name", "city", "updated_at")


@query("change_stream", _STREAM_SQL)
def change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents after one run of the stream."""
    return _streamed(spark, sf_dir, scratch(spark), 1)


@query("stream_replay", _STREAM_SQL)
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after all batches are replayed from the start, as after a lost checkpoint."""
    return _streamed(spark, sf_dir, scratch(spark), 2)


@query("stream_rejects", "SELECT '{broken ' || event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that the stream set aside."""
    root = scratch(spark)
    _streamed(spark, sf_dir, root, 1)
    return spark.read.schema("value string").json(f"{root}/rejects/batch=*").groupBy("value").agg(F.count("*").alias("n"))


@query(
    "partner_file",
    "SELECT 'V-' || s_suppkey AS external_id, s_name AS property_name, CAST(s_nationkey AS VARCHAR) AS bedroom_count FROM supplier",
)
def partner_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of partner files in the three shapes: a flat list, and lists under two names."""
    root = scratch(spark)
    record = F.struct(
        F.concat(F.lit("V-"), F.col("s_suppkey").cast("string")).alias("external_id"),
        F.col("s_name").alias("property_name"),
        F.col("s_nationkey").alias("bedroom_count"),
        F.struct(F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon")).alias("latlon"),
    )
    rows = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") % 3).alias("shape"), F.floor(F.col("s_suppkey") / 100).alias("chunk"), F.to_json(record).alias("value")
    )
    lists = rows.groupBy("shape", "chunk").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("body"))
    wrapped = (
        F.when(F.col("shape") == 0, F.col("body"))
        .when(F.col("shape") == 1, F.concat(F.lit('{"properties": '), "body", F.lit("}")))
        .otherwise(F.concat(F.lit('{"data": '), "body", F.lit("}")))
    )
    lists.select(wrapped.alias("value")).repartition(4).write.option("maxRecordsPerFile", 1).text(f"{root}/partner")
    return partner_rows(spark, f"{root}/partner/part-*").select("external_id", "property_name", "bedroom_count")
