"""Distance, similarity and duplicate queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.functions.geo import any_point, haversine_m
from lodgeframe.functions.vectors import categorical_match, cosine, numeric_match
from lodgeframe.operators.duplicates import FIELD_WEIGHTS, NUMERIC_FIELDS, find_duplicates, text_fields
from lodgeframe.operators.media import best_images, image_analysis, ranked_images
from lodgeframe.operators.nearest import nearest
from lodgeframe.operators.similar import PLANES, TABLES, similar_all, similar_lsh, similar_to
from lodgeframe.operators.documents import search_documents
from lodgeframe.plans.duplicates import ranked_partner_duplicates
from lodgeframe.plans.nearby import nearby_listings, nearby_place
from lodgeframe.queries.base import LISTING_SQL, haversine_sql, listing_rows, query, scratch, table

# --- distance -------------------------------------------------------------------------------


@query(
    "distance",
    f"""WITH a AS (SELECT c_custkey, c_custkey % 180 - 89 AS lat, c_custkey % 361 - 180 AS lon FROM customer),
    b AS (SELECT c_custkey AS k, (c_custkey * 7) % 180 - 90 AS lat, (c_custkey * 11) % 361 - 180 AS lon FROM customer)
    SELECT c_custkey, round({haversine_sql('a', 'b')}, 3) AS metres FROM a JOIN b ON c_custkey = k""",
)
def distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Great-circle distance between two points of each row."""
    k = F.col("c_custkey")
    metres = haversine_m(
        (k % 180 - 89).cast("double"), (k % 361 - 180).cast("double"), (k * 7 % 180 - 90).cast("double"), (k * 11 % 361 - 180).cast("double")
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(metres, 3).alias("metres"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    lat, lon = 45 + (k * 53 % 3001) / 10000, (k * 37 % 4001 - 2000) / 10000
    return table(spark, sf_dir, "customer").select(k.alias("id"), lat.alias("lat"), lon.alias("lon"))


_NEAR_SQL = """
ranked AS (
  SELECT source_id, id, row_number() OVER (PARTITION BY source_id ORDER BY round(km, 6), {id}) AS rank, km
  FROM (SELECT {source} AS source_id, {target} AS id, {distance} / 1000 AS km FROM listing s JOIN listing t
    ON s.k <> t.k AND abs(s.lat - t.lat) < 0.1 AND {published} WHERE {distance} <= {radius} * 1000))
"""


def _near_sql(source: str, target: str, radius: float, published: str = "true", order: str = "id") -> str:
    return _NEAR_SQL.format(source=source, target=target, distance=haversine_sql("s", "t"), radius=radius, published=published, id=order)


@query(
    "nearest_n",
    f"""WITH {LISTING_SQL}, {_near_sql('s.k', 't.k', 5)}
    SELECT source_id, id, CAST(rank AS INTEGER) AS rank, round(km, 2) AS distance_km FROM ranked WHERE rank <= 20""",
)
def nearest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest others within 5 km of every listing."""
    points = _points(spark, sf_dir)
    return nearest(points, points, 5, 20)


@query(
    "nearest_n_crowded",
    f"""WITH listing AS (SELECT o_orderkey AS k, 45 + (o_orderkey * 53 % 701) / 100000 AS lat, (o_orderkey * 37 % 503) / 100000 AS lon FROM orders),
      ranked AS (SELECT s.k AS source_id, t.k AS id, {haversine_sql('s', 't')} / 1000 AS km,
          row_number() OVER (PARTITION BY s.k ORDER BY round({haversine_sql('s', 't')} / 1000, 6), t.k) AS rank
        FROM listing s JOIN listing t ON floor(s.lat * 1000) BETWEEN floor(t.lat * 1000) - 1 AND floor(t.lat * 1000) + 1
          AND floor(s.lon * 1000) BETWEEN floor(t.lon * 1000) - 1 AND floor(t.lon * 1000) + 1 AND s.k <> t.k)
    SELECT source_id, id, CAST(rank AS INTEGER) AS rank, round(km, 2) AS distance_km FROM ranked WHERE rank <= 3""",
)
def nearest_n_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 nearest others of every order, all orders placed in one quarter of a city."""
    k = F.col("o_orderkey")
    lat, lon = 45 + (k * 53 % 701) / 100000, (k * 37 % 503) / 100000
    points = table(spark, sf_dir, "orders").select(k.alias("id"), lat.alias("lat"), lon.alias("lon"))
    return nearest(points, points, 5, 3)


@query(
    "nearby_place",
    f"""WITH {LISTING_SQL}, here AS (SELECT 45.15 AS lat, 0.01 AS lon), near AS (
      SELECT external_id AS id, property_name, city, country, CAST(price AS DOUBLE) AS usd_price, star_rating,
        {haversine_sql('h', 'l')} / 1000 AS km FROM listing l, here h WHERE is_published)
    SELECT id, property_name, city, country, usd_price, star_rating, round(km, 2) AS distance_km FROM near
    WHERE km <= 8 ORDER BY round(km, 6), id LIMIT 20""",
)
def nearby_one_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest published listings within 8 km of one place."""
    return nearby_place(search_documents(listing_rows(spark, sf_dir)), 45.15, 0.01, 8, 20)


@query(
    "nearby_listings",
    f"""WITH {LISTING_SQL}, {_near_sql('s.external_id', 't.external_id', 4, 't.is_published')}
    SELECT source_id, CAST(rank AS INTEGER) AS rank, id, property_name, city, country, CAST(price AS DOUBLE) AS usd_price, star_rating,
      round(km, 2) AS distance_km FROM ranked JOIN listing ON id = external_id WHERE rank <= 5""",
)
def nearby_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest published listings within 4 km of every listing, published or not."""
    return nearby_listings(search_documents(listing_rows(spark, sf_dir)), radius_km=4, limit=5)


@query(
    "nearby_unpublished",
    f"""WITH {LISTING_SQL}, {_near_sql('s.external_id', 't.external_id', 4)}
    SELECT source_id, CAST(rank AS INTEGER) AS rank, id, property_name, city, country, CAST(price AS DOUBLE) AS usd_price, star_rating,
      round(km, 2) AS distance_km FROM ranked JOIN listing ON id = external_id
    WHERE rank <= 5 AND source_id IN (SELECT 'BC-' || user_id FROM events WHERE event_type = 'view')""",
)
def nearby_for_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest listings, unpublished ones too, of the listings that were viewed."""
    viewed = table(spark, sf_dir, "events").where("event_type = 'view'")
    ids = viewed.select(F.concat(F.lit("BC-"), F.col("user_id").cast("string")).alias("id")).distinct()
    return nearby_listings(search_documents(listing_rows(spark, sf_dir)), ids, 4, 5, published_only=False)


# --- vectors --------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), (F.col("label") % 2 == 0).alias("published")
    )


_SIMILAR_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label % 2 = 0 AS published FROM embeddings),
p AS (SELECT a.vec_id AS source_id, b.vec_id AS id, round(list_cosine_similarity(a.v, b.v), 6) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, id) AS rank FROM p)
SELECT source_id, id, CAST(rank AS INTEGER) AS rank, score FROM r WHERE rank <= {k}
"""


@query("similar_top_k", _SIMILAR_SQL.format(where="b.published", k=5))
def similar_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 most similar published vectors of every vector."""
    return similar_all(_vectors(spark, sf_dir), 5)


@query("similar_top_k_unfiltered", _SIMILAR_SQL.format(where="true", k=3))
def similar_top_k_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 most similar vectors of every vector, published or not."""
    return similar_all(_vectors(spark, sf_dir), 3, published_only=False)


# The hyperplanes by the same rule, and candidates that share a table's code.
_LSH_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label % 2 = 0 AS published FROM embeddings),
planes AS (SELECT p, list_transform(range(0, 64), lambda d: (((p * 7919 + d * 104729 + 12345) % 1000003))) AS a FROM range(0, {tables} * {planes}) r(p)),
mixed AS (SELECT p, list_transform(a, lambda x: (x * x + 57 * x + 11) % 1000003) AS b FROM planes),
signs AS (SELECT p, list_transform(b, lambda x: CAST(x * x // 7 % 2 * 2 - 1 AS DOUBLE)) AS s FROM mixed),
codes AS (SELECT vec_id, p // {planes} AS t, sum(CASE WHEN list_dot_product(v, s) > 0 THEN 1 << (p % {planes}) ELSE 0 END) AS code
  FROM e CROSS JOIN signs GROUP BY vec_id, t),
c AS (SELECT DISTINCT a.vec_id AS x, b.vec_id AS y FROM codes a JOIN codes b ON a.t = b.t AND a.code = b.code AND a.vec_id <> b.vec_id),
p AS (SELECT x AS source_id, y AS id, round(list_cosine_similarity(a.v, b.v), 6) AS score
  FROM c JOIN e a ON a.vec_id = x JOIN e b ON b.vec_id = y WHERE b.published),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, id) AS rank FROM p)
SELECT source_id, id, CAST(rank AS INTEGER) AS rank, score FROM r WHERE rank <= 5
"""


@query("similar_lsh", _LSH_SQL.format(tables=TABLES, planes=PLANES))
def similar_by_hyperplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 most similar published vectors among those that share a bucket of random hyperplanes with each vector."""
    return similar_lsh(_vectors(spark, sf_dir), 5)


@query("similar_to_ids", _SIMILAR_SQL.format(where="b.published AND a.vec_id IN (SELECT s_suppkey FROM supplier)", k=5))
def similar_to_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a list of ids, answered by one scan."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return similar_to(_vectors(spark, sf_dir), ids, 5)


@query(
    "vector_cosine",
    """SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def vector_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of each vector and its successor."""
    e = table(spark, sf_dir, "embeddings")
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return e.join(following, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("next")), 6).alias("similarity"))


@query(
    "match_scores",
    """SELECT o_orderkey, CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS numeric_match,
      CASE WHEN p <> '' AND q <> '' AND lower(trim(p)) = lower(trim(q)) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS categorical_match
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 3 END AS a, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 3 END AS b,
      CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 7 <> 1 THEN ' ' || o_orderstatus END AS p,
      CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_custkey % 2 = 0 THEN lower(o_orderstatus) ELSE 'x' END AS q FROM orders)""",
)
def match_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact scores of numbers and categories; a missing side scores 0."""
    o, c, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    a, b = F.when(o % 5 != 0, o % 3), F.when(o % 5 != 0, c % 3)
    p = F.when(o % 7 == 0, "").when(o % 7 != 1, F.concat(F.lit(" "), status))
    q = F.when(o % 7 == 0, "").when(c % 2 == 0, F.lower(status)).otherwise("x")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", numeric_match(a, b).alias("numeric_match"), categorical_match(p, q).alias("categorical_match")
    )


# --- duplicates -----------------------------------------------------------------------------


def _document_listings(spark: SparkSession, sf_dir: str, partner: bool) -> DataFrame:
    """Documents as listings: those of one language and source share a site, a few streets wide."""
    d, site = F.col("doc_id"), F.substring_index("source", "c", -1).cast("int")
    shift = 1 if partner else 0
    lat = (45 + site) + (d * 3 + shift) % 7 * 2 / 10000
    lon = F.length("source") + F.ascii("lang") + d % 5 * 2 / 10000
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("P-" if partner else "D-"), d.cast("string")).alias("external_id"),
        F.format_string("SRID=4326;POINT (%s %s)", lon.cast("string"), lat.cast("string")).alias("latlon"),
        F.concat_ws(" ", F.lit("House"), "lang", (d % 4).cast("string")).alias("property_name"),
        F.when(d % 3 == 0, "House").otherwise("Holiday House").alias("property_type"),
        F.concat_ws(" ", "source", "lang").alias("location_display"),
        F.col("text").alias("property_description"),
        F.when(d % 6 != 0, "No smoking").alias("other_policy"),
        ((d + shift) % 2).cast("int").alias("bedroom_count"),
        F.when(d % 5 != 0, (d % 2).cast("int")).alias("bathroom_count"),
    )


def _side_sql(name: str, prefix: str, shift: int) -> str:
    return f"""
{name} AS (SELECT '{prefix}-' || doc_id AS id,
    (45 + CAST(string_split(source, 'c')[-1] AS INTEGER)) + (doc_id * 3 + {shift}) % 7 * 2 / 10000 AS lat,
    length(source) + ascii(lang) + doc_id % 5 * 2 / 10000 AS lon,
    'House ' || lang || ' ' || (doc_id % 4) AS property_name, CASE WHEN doc_id % 3 = 0 THEN 'House' ELSE 'Holiday House' END AS property_type,
    source || ' ' || lang AS location_display, text AS property_description, CASE WHEN doc_id % 6 <> 0 THEN 'No smoking' END AS other_policy,
    (doc_id + {shift}) % 2 AS bedroom_count, CASE WHEN doc_id % 5 <> 0 THEN doc_id % 2 END AS bathroom_count FROM documents)"""


_FIELDS = text_fields(FIELD_WEIGHTS)
_SCORE_SQL = f"""
texts AS (SELECT DISTINCT md5(t) AS k, t FROM ({" UNION ALL ".join(f"SELECT {f} AS t FROM {side} WHERE {f} <> ''" for f in _FIELDS for side in ("own", "partner"))})),
terms AS (SELECT k, w, count(*) AS n FROM (SELECT k, unnest(regexp_split_to_array(lower(t), '[\\x00-/:-@\\[-`{{-\\x7f]+')) AS w FROM texts)
  WHERE w <> '' GROUP BY k, w),
sizes AS (SELECT k, sum(n * n) AS norm2 FROM terms GROUP BY k),
near AS (SELECT s.id AS source_id, c.id AS candidate_id, {haversine_sql('s', 'c')} AS metres,
    {", ".join(f"s.{f} AS s_{f}, c.{f} AS c_{f}" if f in NUMERIC_FIELDS else f"md5(nullif(s.{f}, '')) AS s_{f}, md5(nullif(c.{f}, '')) AS c_{f}" for f in FIELD_WEIGHTS)}
  FROM own s JOIN partner c ON abs(s.lat - c.lat) < 0.01 AND abs(s.lon - c.lon) < 0.01 WHERE {haversine_sql('s', 'c')} <= 100),
compared AS (SELECT DISTINCT a, b FROM ({" UNION ALL ".join(f"SELECT s_{f} AS a, c_{f} AS b FROM near" for f in _FIELDS)}) WHERE a IS NOT NULL AND b IS NOT NULL),
dots AS (SELECT a, b, sum(x.n * y.n) AS dot FROM compared JOIN terms x ON x.k = a JOIN terms y ON y.k = b AND y.w = x.w GROUP BY a, b),
cosines AS (SELECT a, b, dot / sqrt(CAST(x.norm2 AS DOUBLE) * CAST(y.norm2 AS DOUBLE)) AS cosine
  FROM dots JOIN sizes x ON x.k = a JOIN sizes y ON y.k = b),
scored AS (SELECT source_id, candidate_id, metres,
    {", ".join(
        f"CASE WHEN s_{f} = c_{f} THEN 1.0 ELSE 0.0 END AS {f}" if f in NUMERIC_FIELDS
        else f"coalesce(x_{f}.cosine, 0.0) AS {f}" for f in FIELD_WEIGHTS)}
  FROM near {" ".join(f"LEFT JOIN cosines x_{f} ON x_{f}.a = s_{f} AND x_{f}.b = c_{f}" for f in _FIELDS)}), matched AS (SELECT *, round({" + ".join(f"{f} * {w}::DOUBLE" for f, w in FIELD_WEIGHTS.items())}, 4) AS overall_score FROM scored)
"""
_DUPLICATE_SQL = f"""WITH {_side_sql('own', 'D', 0)}, {_side_sql('partner', 'P', 1)}, {_SCORE_SQL}
SELECT source_id, candidate_id, round(metres, 1) AS distance_m, round(property_description, 3) AS description_score, overall_score
FROM matched WHERE overall_score >= 0.75"""


@query("duplicate_pairs", _DUPLICATE_SQL)
def duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of listings at most 100 m apart that score at least 0.75."""
    found = find_duplicates(_document_listings(spark, sf_dir, False), _document_listings(spark, sf_dir, True))
    return found.select(
        "source_id",
        "candidate_id",
        "distance_m",
        F.round("scores.property_description", 3).alias("description_score"),
        F.col("scores.overall_score").alias("overall_score"),
    )


def _partner_file(listings: DataFrame, path: str) -> None:
    """The listings as a partner's files, lists of about a thousand: a short way north, some renamed or with one more bedroom."""
    k = F.col("feed_provider_id").cast("bigint")
    point = any_point(F.col("latlon"))
    place = F.struct((point["lat"] + 0.0003).alias("lat"), point["lon"].alias("lon"))
    name = F.when(k % 2 == 0, F.col("property_name")).otherwise(F.concat(F.lit("Casa "), "property_name"))
    rows = listings.select(
        F.floor(k / 1000).alias("file"), F.concat(F.lit("V-"), k.cast("string")).alias("external_id"), place.alias("latlon"), name.alias("property_name"), "property_type", "location_display",
        (F.col("bedroom_count") + F.when(k % 7 == 0, 1).otherwise(0)).alias("bedroom_count"), "bathroom_count", "property_description", "other_policy",
    )
    items = F.collect_list(F.to_json(F.struct(*[c for c in rows.columns if c != "file"])))
    files = rows.groupBy("file").agg(F.concat(F.lit("["), F.concat_ws(",", items), F.lit("]")).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)


_TABLE_SIDES_SQL = f"""{LISTING_SQL},
own AS (SELECT external_id AS id, lat, lon, property_name, property_type, location_display, property_description,
  CASE WHEN eco THEN 'We are eco-friendly' ELSE 'Please do not smoke' END AS other_policy, bedroom_count, bathroom_count FROM listing),
partner AS (SELECT 'V-' || k AS id, lat + 0.0003 AS lat, lon, CASE WHEN k % 2 = 0 THEN property_name ELSE 'Casa ' || property_name END AS property_name,
  property_type, location_display, property_description, CASE WHEN eco THEN 'We are eco-friendly' ELSE 'Please do not smoke' END AS other_policy,
  bedroom_count + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS bedroom_count, bathroom_count FROM listing)"""


@query(
    "duplicate_flow",
    f"""WITH {_TABLE_SIDES_SQL}, {_SCORE_SQL}
    SELECT row_number() OVER (ORDER BY overall_score DESC, source_id, candidate_id) AS rank, source_id, candidate_id,
      round(metres, 1) AS distance_m, round(property_name, 3) AS name_score, overall_score FROM matched WHERE overall_score >= 0.75""",
)
def duplicate_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates between the written listing table and a partner's files, with each pair's place in the order of the best match."""
    listings = listing_rows(spark, sf_dir)
    path = f"{scratch(spark)}/partner"
    _partner_file(listings, path)
    found = ranked_partner_duplicates(spark, listings, path)
    return found.select(
        "rank", "source_id", "candidate_id", "distance_m", F.round("scores.property_name", 3).alias("name_score"), F.col("scores.overall_score").alias("overall_score")
    )


# --- media ----------------------------------------------------------------------------------


def _image_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, v = F.col("event_id"), F.col("value")
    labels = F.create_map(
        F.lit("bedroom"), (e % 7) / 10.0, F.lit("balcony"), (e % 5) / 10.0, F.lit("bathroom"), (e % 3) / 10.0, F.lit("house"), F.lit(0.25)
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("listing_id"),
        F.concat(F.lit("img-"), e.cast("string")).alias("url"),
        F.when(e % 11 != 0, v / (v + 50)).alias("aesthetic"),
        labels.alias("label_scores"),
    )


_MEDIA_SQL = """
WITH i AS (SELECT user_id AS listing_id, 'img-' || event_id AS url, round(value / (value + 50) * 10, 2) AS aesthetic_score,
    CASE WHEN event_id % 7 >= greatest(event_id % 5, event_id % 3, 2.5) THEN 'bedroom'
      WHEN event_id % 5 >= greatest(event_id % 3, 2.5) THEN 'balcony' WHEN event_id % 3 >= 2.5 THEN 'bathroom' ELSE 'house' END AS label,
    round(greatest(event_id % 7, event_id % 5, event_id % 3, 2.5) / 10.0, 4)::DOUBLE AS label_confidence
  FROM events WHERE event_id % 11 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY aesthetic_score DESC, url) AS rank FROM i)
"""


@query(
    "best_media_top4",
    _MEDIA_SQL + "SELECT listing_id, CAST(rank AS INTEGER) AS rank, url, aesthetic_score, label, label_confidence FROM r WHERE rank <= 4",
)
def best_media_top4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 4 best photos of every listing, with label."""
    best = best_images(image_analysis(_image_scores(spark, sf_dir)))
    return best.select("listing_id", "rank", "url", "aesthetic_score", "label", "label_confidence")


@query(
    "ranked_media",
    _MEDIA_SQL
    + """SELECT listing_id, arg_min(url, rank) AS ranked_image, CAST(count(*) AS INTEGER) AS images, string_agg(url, ' ' ORDER BY rank) AS urls
    FROM r WHERE rank <= 4 GROUP BY listing_id""",
)
def ranked_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best photo and the list of the 4 best, per listing."""
    lists = ranked_images(best_images(image_analysis(_image_scores(spark, sf_dir))))
    images = F.col("ranked_images.Count").alias("images")
    return lists.select("listing_id", "ranked_image", images, F.array_join("ranked_images.Images", " ").alias("urls"))
