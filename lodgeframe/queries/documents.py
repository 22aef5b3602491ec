"""Search, export, history and vector documents; sitemaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.functions.geo import point_lat, point_lon
from lodgeframe.functions.ids import uuid5_dns
from lodgeframe.operators.documents import (
    embedding_text,
    export_documents,
    kv_items,
    property_attributes,
    search_documents,
    skipped_documents,
    vector_points,
)
from lodgeframe.operators.nearest import nearest
from lodgeframe.operators.documents import nearby_points
from lodgeframe.operators.sitemap import FOOTER, HEADER, Site, assign_files, file_name, image_urls, index_lines, lastmod, nearby_sitemap_rows, url_blocks
from lodgeframe.operators.text_vectors import distinct_texts, tfidf_vectors
from lodgeframe.plans.nearby import similar_listings
from lodgeframe.queries.base import LISTING_SQL, haversine_sql, listing_rows, query, scratch, table
from lodgeframe.sinks.exports import export_json, export_points, latest_items
from lodgeframe.sinks.keyed_store import KeyedStore
from lodgeframe.sinks.sitemaps import write_sitemaps
from lodgeframe.sources.tables import exported_documents, sitemap_rows

# --- documents ------------------------------------------------------------------------------


@query(
    "point_columns",
    f"WITH {LISTING_SQL} SELECT external_id, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM listing",
)
def point_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of EWKT text."""
    return listing_rows(spark, sf_dir).select("external_id", point_lat(F.col("latlon")).alias("lat"), point_lon(F.col("latlon")).alias("lon"))


_ATTRIBUTES_SQL = """concat_ws('|', CASE WHEN family_friendly THEN 'Family Friendly' END, CASE WHEN group_friendly THEN 'Group Friendly' END,
  CASE WHEN free_cancellation THEN 'Free Cancellation' END)"""


@query(
    "property_attributes",
    f"WITH {LISTING_SQL} SELECT external_id, {_ATTRIBUTES_SQL} AS attributes FROM listing",
)
def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the attributes that hold."""
    free = F.get_json_object("policy", "$.free_cancellation") == "true"
    names = property_attributes(F.col("family_friendly"), F.col("group_friendly"), free)
    return listing_rows(spark, sf_dir).select("external_id", F.array_join(names, "|").alias("attributes"))


@query(
    "search_document",
    f"""WITH {LISTING_SQL} SELECT external_id AS id, feed_provider_id, feed, feed_provider_url, property_name, property_slug, property_type,
      property_type_category, city, country, country_code, location_display AS display, round(lon, 4) AS lon, round(lat, 4) AS lat, star_rating,
      CAST(review_score_general AS DOUBLE) AS review_score_general, number_of_review, bedroom_count, bathroom_count, occupancy,
      CAST(price AS DOUBLE) AS usd_price, min_stay, feature_image, array_to_string(amenity_categories, '|') AS amenity_categories,
      eco AS eco_friendly, work_friendly, {_ATTRIBUTES_SQL} AS property_attributes, is_published AS published,
      strftime(synced, '%Y-%m-%dT%H:%M:%S') AS created_at, strftime(synced, '%Y-%m-%dT%H:%M:%S') AS updated_at FROM listing""",
)
def search_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents, lists and maps flattened."""
    docs = search_documents(listing_rows(spark, sf_dir))
    flags = F.col("property_flags")
    return docs.select(
        *[c for c in docs.columns if c not in ("lonlat", "amenity_categories", "property_flags", "property_attributes")],
        F.col("lonlat")[0].alias("lon"),
        F.col("lonlat")[1].alias("lat"),
        F.array_join("amenity_categories", "|").alias("amenity_categories"),
        flags["eco_friendly_home"].alias("eco_friendly"),
        flags["work_friendly_home"].alias("work_friendly"),
        F.array_join("property_attributes", "|").alias("property_attributes"),
    )


_EXPORT_SQL = f"""WITH {LISTING_SQL} SELECT external_id AS id, feed, city, country, country_code, location_display AS display,
  CAST(lat AS VARCHAR) AS lat, CAST(lon AS VARCHAR) AS lng, partner_location_id AS location_id, array_to_string(amenities, '|') AS partner_amenities,
  CASE WHEN free_cancellation THEN 'Free cancellation' ELSE 'No free cancellation' END AS cancellation,
  CASE WHEN min_age >= 18 THEN 'Only adults are allowed to check in' ELSE 'Anyone can check in' END AS checkin,
  CASE pets WHEN 'no' THEN 'Pets are not allowed' WHEN 'yes' THEN 'Pets are allowed' ELSE 'Pet policy not specified' END AS pet_text,
  feed_provider_url AS url, coalesce(min_age >= 18, false) AS adult_only, bathroom_count, bedroom_count, occupancy, number_of_review,
  feature_image, len(images)::INTEGER AS image_count, array_to_string(images, '|') AS images, CAST(NULL AS VARCHAR) AS other_policy,
  property_description, coalesce(pets = 'yes', false) AS is_pet_friendly, long_stay, min_stay, CAST(price AS DOUBLE) AS price,
  property_name, property_slug, property_type, CAST(review_score_general AS DOUBLE) AS review_score, star_rating,
  strftime(synced, '%Y-%m-%dT%H:%M:%S') AS updated_at, work_friendly, is_published AS published FROM listing"""


def _flat_export(docs: DataFrame) -> DataFrame:
    paths = {
        "id": "ID", "feed": "Feed", "city": "City", "country": "Country", "country_code": "CountryCode", "display": "Display", "lat": "Lat",
        "lng": "Lng", "location_id": "LocationID", "cancellation": "Partner.Policies.CancellationPolicy",
        "checkin": "Partner.Policies.CheckinPolicy", "pet_text": "Partner.Policies.PetPolicy", "url": "Partner.URL",
        "adult_only": "Property.AdultOnly", "bathroom_count": "Property.Counts.Bathroom", "bedroom_count": "Property.Counts.Bedroom",
        "occupancy": "Property.Counts.Occupancy", "number_of_review": "Property.Counts.Reviews", "feature_image": "Property.FeatureImage",
        "image_count": "Property.Image.Count", "other_policy": "Property.OtherPolicy", "property_description": "Property.PropertyDescription",
        "is_pet_friendly": "Property.IsPetFriendly", "long_stay": "Property.LongStayFriendlyHome", "min_stay": "Property.MinStay",
        "price": "Property.Price", "property_name": "Property.PropertyName", "property_slug": "Property.PropertySlug",
        "property_type": "Property.PropertyType", "review_score": "Property.ReviewScore", "star_rating": "Property.StarRating",
        "updated_at": "Property.UpdatedAt", "work_friendly": "Property.WorkFriendlyHome", "published": "Published",
    }
    lists = {"partner_amenities": "Partner.Amenities", "images": "Property.Image.Images"}
    return docs.select(
        *[F.col(p).alias(n) for n, p in paths.items()], *[F.array_join(p, "|").alias(n) for n, p in lists.items()]
    )


@query("export_document", _EXPORT_SQL)
def export_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested export documents, flattened."""
    return _flat_export(export_documents(listing_rows(spark, sf_dir)))


@query("export_round_trip", _EXPORT_SQL)
def export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after writing JSON files for two days and reading one of them."""
    rows, root = listing_rows(spark, sf_dir), scratch(spark)
    export_json(rows.where("is_published"), root, "20240101")
    export_json(rows, root, "20240102")
    return _flat_export(exported_documents(spark, root, "20240102", export_documents(rows).schema))


@query(
    "kv_item",
    f"""WITH {LISTING_SQL} SELECT country_code, 'en-us' AS language, external_id AS property_id, property_name, property_slug,
      is_published AS published, strftime(synced, '%Y%m%d') AS timestamp, CAST(price AS DOUBLE) AS usd_price FROM listing""",
)
def kv_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History items."""
    return kv_items(listing_rows(spark, sf_dir)).withColumn("usd_price", F.col("usd_price").cast("double"))


def _order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows over time: one per order, some without a day."""
    orders = table(spark, sf_dir, "orders")
    at = F.timestamp_seconds(F.unix_timestamp(F.date_trunc("month", "o_orderdate")) + F.col("o_orderkey"))
    return orders.select(
        F.lower("o_orderstatus").alias("country_code"),
        F.lit("en-us").alias("language"),
        F.concat(F.lit("BC-"), F.col("o_custkey").cast("string")).alias("external_id"),
        F.col("o_orderpriority").alias("property_name"),
        F.lit("s").alias("property_slug"),
        (F.col("o_orderstatus") == "O").alias("is_published"),
        F.when(F.col("o_orderkey") % 50 != 0, at).alias("last_synced_at"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("price"),
    )


# The listed orders of one customer and day, the last synced one first.
_HISTORY_SQL = """
WITH h AS (SELECT *, row_number() OVER (PARTITION BY property_id, timestamp ORDER BY synced DESC) AS rn FROM (
    SELECT 'BC-' || o_custkey AS property_id, strftime(synced, '%Y%m%d') AS timestamp, synced, o_orderpriority AS property_name,
      lower(o_orderstatus) AS country_code, o_orderstatus = 'O' AS published, CAST(o_totalprice AS DOUBLE) AS usd_price
    FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) + to_seconds(o_orderkey) AS synced FROM orders WHERE o_orderkey % 50 <> 0)))
"""
_HISTORY_COLUMNS = "property_id, timestamp, property_name, country_code, published, usd_price"


def _shown_items(items: DataFrame) -> DataFrame:
    return items.select(*[F.col(c).cast("double").alias(c) if c == "usd_price" else F.col(c) for c in _HISTORY_COLUMNS.split(", ")])


@query("kv_history", f"{_HISTORY_SQL} SELECT {_HISTORY_COLUMNS} FROM h WHERE rn = 1")
def kv_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing's history: one item per day, the last one wins, written to and read from the store."""
    items = latest_items(_order_history(spark, sf_dir))
    store = KeyedStore(spark, f"{scratch(spark)}/history", ["property_id", "timestamp"], items.schema, buckets=8)
    store.upsert(items)
    store.upsert(items)  # written again, nothing changes
    return _shown_items(store.read())


@query(
    "kv_point_get",
    f"""{_HISTORY_SQL} SELECT {_HISTORY_COLUMNS} FROM h WHERE rn = 1
    AND (property_id, timestamp) IN (SELECT ('BC-' || o_custkey, strftime(date_trunc('month', o_orderdate), '%Y%m%d')) FROM orders)""",
)
def kv_point_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by listing and day, looked up in a store."""
    wanted = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("BC-"), F.col("o_custkey").cast("string")).alias("property_id"),
        F.date_format(F.date_trunc("month", "o_orderdate"), "yyyyMMdd").alias("timestamp"),
    )
    items = latest_items(_order_history(spark, sf_dir))
    store = KeyedStore(spark, f"{scratch(spark)}/history", ["property_id", "timestamp"], items.schema, buckets=8)
    store.upsert(items)
    return _shown_items(store.lookup(wanted))


# --- vectors --------------------------------------------------------------------------------

_TEXT_SQL = """concat_ws(' | ', nullif(property_name, ''), nullif(property_type, ''), city, country, property_description,
  array_to_string(amenity_categories, ', '), array_to_string(amenities, ', '), CASE WHEN pets = 'yes' THEN 'pet friendly' END,
  CASE WHEN min_age >= 18 THEN 'adults only' END, CASE WHEN long_stay THEN 'long stay friendly' END, CASE WHEN work_friendly THEN 'work friendly' END)"""


@query("embedding_text", f"WITH {LISTING_SQL} SELECT external_id AS id, {_TEXT_SQL} AS text FROM listing")
def embedding_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that stands for a listing in similarity search."""
    docs = export_documents(listing_rows(spark, sf_dir))
    return docs.select(F.col("ID").alias("id"), embedding_text(docs).alias("text"))


def _uuid_sql(name: str) -> str:
    digest = f"sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))"
    return f"""(SELECT substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-'
      || substr('89ab', (instr('0123456789abcdef', substr(d, 17, 1)) - 1) % 4 + 1, 1) || substr(d, 18, 3) || '-' || substr(d, 21, 12) FROM (SELECT {digest} AS d))"""


@query("point_id", f"SELECT p_partkey, {_uuid_sql("'BC-' || p_partkey")} AS point_id FROM part")
def point_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic ids of vector points."""
    name = F.concat(F.lit("BC-"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", uuid5_dns(name).alias("point_id"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector points of listings."""
    docs = export_documents(listing_rows(spark, sf_dir))
    return vector_points(docs, _text_embeddings(spark, sf_dir, docs))


def _text_embeddings(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """(text, vector, k): for every document a supplied embedding, chosen by customer number."""
    e = table(spark, sf_dir, "embeddings")
    number = F.substring_index("ID", "-", -1).cast("bigint")
    texts = docs.select(embedding_text(docs).alias("text"), number.alias("k"), (number % e.count()).alias("vec_id"))
    return texts.join(e, "vec_id").select("text", F.col("embedding").alias("vector"), "k")


@query("vector_export", f"""WITH {LISTING_SQL} SELECT external_id, CASE WHEN k % 7 = 0 THEN 'no vector' ELSE 'stored' END AS outcome FROM listing""")
def vector_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's documents written as JSON, read back, joined to the vectors of their texts, stored; the rest by reason."""
    root, day = scratch(spark), "20240102"
    listings = listing_rows(spark, sf_dir)
    export_json(listings, f"{root}/documents", day)
    docs = exported_documents(spark, f"{root}/documents", day, export_documents(listings).schema)
    vectors = _text_embeddings(spark, sf_dir, docs).where("k % 7 <> 0")
    store = KeyedStore(spark, f"{root}/points", ["point_id"], vector_points(docs, vectors).schema)
    export_points(docs, vectors, store)
    stored = store.read().select(F.col("payload.external_id").alias("external_id"), F.lit("stored").alias("outcome"))
    return stored.unionByName(skipped_documents(docs, vectors).withColumnRenamed("reason", "outcome"))


@query(
    "vector_points",
    f"""WITH {LISTING_SQL} SELECT {_uuid_sql("external_id")} AS point_id, external_id, city, CAST(price AS DOUBLE) AS usd_price, is_published AS published,
      coalesce(pets = 'yes', false) AS is_pet_friendly, coalesce(min_age >= 18, false) AS adult_only, min_stay, round(CAST(embedding[1] AS DOUBLE), 6) AS first
    FROM listing JOIN embeddings ON vec_id = k % (SELECT count(*) FROM embeddings)""",
)
def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector points: id, vector and payload, upserted into a store and read back."""
    rows = _points(spark, sf_dir)
    store = KeyedStore(spark, f"{scratch(spark)}/points", ["point_id"], rows.schema, buckets=8)
    store.upsert(rows)
    names = "external_id city usd_price published is_pet_friendly adult_only min_stay".split()
    shown = [F.col(f"payload.{n}").alias(n) for n in names]
    return store.read().select("point_id", *shown, F.round(F.col("vector")[0].cast("double"), 6).alias("first"))


@query(
    "similar_listings",
    f"""WITH {LISTING_SQL}, e AS (SELECT external_id, property_name, city, is_published, CAST(embedding AS DOUBLE[]) AS v FROM listing JOIN embeddings ON vec_id = k % (SELECT count(*) FROM embeddings)),
    r AS (SELECT a.external_id AS source_id, b.external_id, b.property_name, b.city, round(list_cosine_similarity(a.v, b.v), 6) AS score,
        row_number() OVER (PARTITION BY a.external_id ORDER BY round(list_cosine_similarity(a.v, b.v), 6) DESC, b.external_id) AS rank
      FROM e a JOIN e b ON a.external_id <> b.external_id AND b.is_published)
    SELECT source_id, CAST(rank AS INTEGER) AS rank, external_id, property_name, city, score FROM r WHERE rank <= 5""",
)
def similar_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 most similar published listings of every listing, with payload."""
    found = similar_listings(_points(spark, sf_dir))
    return found.select("source_id", "rank", "external_id", "property_name", "city", "score")


@query("text_vectors")
def text_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit word vectors of all distinct document and page-derived texts."""
    texts = distinct_texts(table(spark, sf_dir, "documents").select("text"), table(spark, sf_dir, "conversations").select("text"))
    return tfidf_vectors(texts).select(F.md5("text").alias("text_id"), "vector")


# --- sitemaps -------------------------------------------------------------------------------

SITE = Site()


def _escape_sql(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _block_sql(listing_id: str, slug: str, modified: str, images: str) -> str:
    path = f"coalesce(nullif({slug}, ''), 'listing') || '/' || {listing_id}"
    links = " || ".join(
        f"""'    <xhtml:link rel="alternate" hreflang="{tag}" href="' || {_escape_sql(f"'{base}/property/' || {path}")} || '"/>' || chr(10)"""
        for tag, base in SITE.alternates.items()
    )
    return f"""'  <url>' || chr(10) || '    <loc>' || {_escape_sql(f"'{SITE.base}/property/' || {path}")} || '</loc>' || chr(10)
      || '    <lastmod>' || {_escape_sql(modified)} || '</lastmod>' || chr(10) || {links}
      || coalesce(array_to_string(list_transform({images}, lambda u: '    <image:image>' || chr(10) || '      <image:loc>' || {_escape_sql('u')}
      || '</image:loc>' || chr(10) || '    </image:image>' || chr(10)), ''), '') || '  </url>' || chr(10)"""


_LISTING_IMAGES_SQL = "CASE WHEN feature_image = '' OR len(images) > 0 THEN images ELSE [feature_image] END"
_LISTING_BLOCK_SQL = _block_sql("external_id", "property_slug", "strftime(synced, '%Y-%m-%dT%H:%M:%S')", _LISTING_IMAGES_SQL)


def _run_ts():
    return F.timestamp_seconds(F.lit(1767225600))


@query("sitemap_blocks", f"WITH {LISTING_SQL} SELECT external_id, {_LISTING_BLOCK_SQL} AS block FROM listing WHERE is_published")
def sitemap_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block of XML per published listing."""
    return url_blocks(sitemap_rows(listing_rows(spark, sf_dir)), SITE, _run_ts())


_FILES_SQL = f"""WITH {LISTING_SQL}, b AS (SELECT external_id, {_LISTING_BLOCK_SQL} AS block FROM listing WHERE is_published),
n AS (SELECT *, row_number() OVER (ORDER BY external_id) - 1 AS position FROM b),
f AS (SELECT *, CAST(position // 100 + 1 AS INTEGER) AS file_no FROM n)"""


@query("sitemap_files", f"{_FILES_SQL} SELECT external_id, position, file_no FROM f")
def sitemap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File of every listing at 100 addresses per file."""
    blocks = url_blocks(sitemap_rows(listing_rows(spark, sf_dir)), SITE, _run_ts())
    return assign_files(blocks, max_urls=100).select("external_id", "position", "file_no")


# Files filled one row after another.
_GREEDY_SQL = f"""WITH RECURSIVE {LISTING_SQL}, b AS (SELECT external_id, {_LISTING_BLOCK_SQL} AS block FROM listing WHERE is_published),
n AS (SELECT *, row_number() OVER (ORDER BY external_id) - 1 AS position, strlen(block) AS size FROM b),
f AS (SELECT external_id, block, position, 1 AS file_no, 1 AS held, {len(HEADER)} + size AS used FROM n WHERE position = 0
  UNION ALL SELECT n.external_id, n.block, n.position, file_no + CAST(over AS INTEGER), CASE WHEN over THEN 1 ELSE held + 1 END,
    CASE WHEN over THEN {len(HEADER)} ELSE used END + n.size
  FROM (SELECT *, position + 1 AS p FROM f) f JOIN n ON n.position = p CROSS JOIN LATERAL (SELECT held >= 40 OR used + n.size > 20000 AS over))"""


@query("sitemap_rollover", f"{_GREEDY_SQL} SELECT external_id, position, file_no FROM f")
def sitemap_rollover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File of every listing at 40 addresses or 20,000 bytes per file, whichever comes first."""
    blocks = url_blocks(sitemap_rows(listing_rows(spark, sf_dir)), SITE, _run_ts())
    return assign_files(blocks, max_urls=40, max_bytes=20_000).select("external_id", "position", "file_no")


@query(
    "sitemap_written",
    f"""{_GREEDY_SQL}, w AS (SELECT file_no, '{HEADER}' || string_agg(block, '' ORDER BY position) || '{FOOTER}' AS body FROM f GROUP BY file_no)
    SELECT 'listing' || CASE WHEN file_no = 1 THEN '' ELSE '-' || file_no END || '.xml.gz' AS file_name, md5(body) AS body_md5, strlen(body) AS bytes FROM w""",
)
def sitemap_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as gzip files, read back: name, hash and size of each file's text."""
    folder = f"{scratch(spark)}/maps"
    write_sitemaps(sitemap_rows(listing_rows(spark, sf_dir)), folder, "listing", SITE, _run_ts(), max_urls=40, max_bytes=20_000)
    # Each path of a pattern would be a root of its own, listed by a task and kept by the driver.
    files = spark.read.option("pathGlobFilter", "*.xml.gz").text(folder, wholetext=True).select(F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("file_name"), "value")
    # A few files of any size are one split, so thousands of short ones would be read by thousands of tasks.
    files = files.coalesce(3 * spark.sparkContext.defaultParallelism)
    return files.select("file_name", F.md5("value").alias("body_md5"), F.octet_length("value").cast("bigint").alias("bytes"))


@query(
    "sitemap_root_index",
    f"""{_FILES_SQL} SELECT DISTINCT 'property-sitemap' || CASE WHEN file_no = 1 THEN '' ELSE '-' || file_no END || '.xml.gz' AS file_name,
      '  <sitemap>' || chr(10) || '    <loc>{SITE.base}/property-sitemap' || CASE WHEN file_no = 1 THEN '' ELSE '-' || file_no END
      || '.xml.gz</loc>' || chr(10) || '    <lastmod>2026-01-01T00:00:00</lastmod>' || chr(10) || '  </sitemap>' || chr(10) AS entry FROM f""",
)
def sitemap_root_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index entries of those files."""
    blocks = url_blocks(sitemap_rows(listing_rows(spark, sf_dir)), SITE, _run_ts())
    names = assign_files(blocks, max_urls=100).select(file_name("property-sitemap", F.col("file_no")).alias("file_name"))
    return index_lines(names, SITE, _run_ts())


@query(
    "page_sitemap_blocks",
    f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN '' ELSE 'p-' || page_id END AS slug, url,
        regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages),
      d AS (SELECT page_id, slug, list_filter(list_concat([url], links), lambda u: u <> '') AS us FROM p)
    SELECT CAST(page_id AS VARCHAR) AS external_id, {_block_sql('page_id', 'slug', "'2026-01-01T00:00:00'",
      "list_filter(us, lambda u, i: list_position(us, u) = i)")} AS block FROM d""",
)
def page_sitemap_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of all pages with every link as an image: repeats dropped, characters escaped, no date known."""
    k = F.col("page_id").cast("string")
    rows = table(spark, sf_dir, "pages").select(
        k.alias("external_id"),
        F.when(F.col("page_id") % 4 == 0, "").otherwise(F.concat(F.lit("p-"), k)).alias("property_slug"),
        F.lit(None).cast("timestamp").alias("last_synced_at"),
        F.col("url").alias("feature_image"),
        F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1).alias("images"),
    )
    return url_blocks(rows, SITE, _run_ts())


@query(
    "image_url_set",
    """WITH l AS (SELECT l_orderkey, list(CASE WHEN l_linestatus = 'O' THEN l_returnflag || l_linenumber ELSE '' END
        ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS us FROM lineitem GROUP BY l_orderkey),
      f AS (SELECT l_orderkey, list_filter(list_concat(['R1'], us), lambda u: u <> '') AS us FROM l)
    SELECT l_orderkey, array_to_string(list_filter(us, lambda u, i: list_position(us, u) = i), ' ') AS urls FROM f""",
)
def image_url_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature image first, then the others in order, empty ones and repeats dropped."""
    url = F.when(F.col("l_linestatus") == "O", F.concat("l_returnflag", F.col("l_linenumber").cast("string"))).otherwise("")
    item = F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", url.alias("url"))
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    urls = image_urls(F.lit("R1"), F.transform("items", lambda i: i["url"]))
    return lists.select("l_orderkey", F.array_join(urls, " ").alias("urls"))


@query(
    "lastmod_text",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' WHEN 1 THEN strftime(ts, '%Y-%m-%dT00:00:00')
      WHEN 2 THEN event_type WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:00+02:00') ELSE '2026-01-01T00:00:00' END AS lastmod FROM events""",
)
def lastmod_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates given as text in several forms."""
    case = F.col("event_id") % 5
    raw = (
        F.when(case == 0, F.concat(F.date_format("ts", " yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z ")))
        .when(case == 1, F.date_format("ts", "yyyy-MM-dd"))
        .when(case == 2, F.concat(F.col("event_type"), F.lit(" ")))
        .when(case == 3, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit("+02:00")))
    )
    events = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return events.select("event_id", lastmod(F.col("raw"), events.schema["raw"].dataType, _run_ts()).alias("lastmod"))


@query(
    "nearby_union",
    f"""WITH {LISTING_SQL}, r AS (SELECT t.external_id, row_number() OVER (PARTITION BY s.k
        ORDER BY round({haversine_sql('s', 't')} / 1000, 6), t.external_id) AS rank
      FROM listing s JOIN listing t ON s.k <> t.k AND abs(s.lat - t.lat) < 0.1 AND s.is_published AND t.is_published
      WHERE {haversine_sql('s', 't')} <= 3000)
    SELECT external_id, property_slug, strftime(synced, '%Y-%m-%dT%H:%M:%S') AS last_synced_at, feature_image, 0 AS images
    FROM listing WHERE external_id IN (SELECT external_id FROM r WHERE rank <= 2)""",
)
def nearby_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap rows of all listings that are among the 2 nearest of some published listing, each once."""
    docs = search_documents(listing_rows(spark, sf_dir)).where("published")
    pts = nearby_points(docs)
    rows = nearby_sitemap_rows(nearest(pts, pts, 3, 2), docs)
    return rows.withColumn("images", F.size("images"))


@query(
    "nearby_union_count",
    f"""WITH {LISTING_SQL} SELECT count(DISTINCT t.external_id) AS listings FROM listing s JOIN listing t
      ON s.k <> t.k AND abs(s.lat - t.lat) < 0.1 AND s.is_published AND t.is_published WHERE {haversine_sql('s', 't')} <= 1000""",
)
def nearby_union_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of distinct listings near some other one."""
    docs = search_documents(listing_rows(spark, sf_dir)).where("published")
    pts = nearby_points(docs)
    return nearest(pts, pts, 1, 1000).select("id").distinct().agg(F.count("*").alias("listings"))
