"""Merge, comparison, filters and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.operators.dedup import drop_ids, keep_ids, keep_last
from lodgeframe.operators.diff import diff_versions, diff_wide_versions
from lodgeframe.operators.merge import INSERT_DEFAULTS, LISTING_RULES, UPDATE_DEFAULTS, merge_counts, merge_keyed, replace_keyed
from lodgeframe.queries.base import LISTING_SQL, listing_rows, query, scratch, table
from lodgeframe.sources.feeds import id_union, price_map
from lodgeframe.sources.tables import VersionedTable, evolve, published_ids, sitemap_rows

# --- snapshot comparison ------------------------------------------------------------------

_PART_COLUMNS = ["property_name", "property_type", "occupancy", "price", "images"]


def _part_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    old = part.select(
        k.cast("string").alias("feed_provider_id"),
        F.col("p_name").alias("property_name"),
        F.col("p_type").alias("property_type"),
        F.when(k % 5 != 0, F.col("p_size")).alias("occupancy"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.array("p_brand").alias("images"),
    )
    # Some keys vanish and new ones appear, some values change, some turn NULL or stop being NULL.
    new = part.select(
        F.when(k % 13 == 0, -k - 1).otherwise(k).cast("string").alias("feed_provider_id"),
        F.when(k % 17 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("property_name"),
        F.col("p_type").alias("property_type"),
        F.when(k % 10 != 0, F.col("p_size")).alias("occupancy"),
        F.when(k % 7 == 0, F.col("p_retailprice") + 1).when(k % 11 != 0, F.col("p_retailprice")).cast("decimal(10,2)").alias("price"),
        F.when(k % 19 == 0, F.array("p_brand", "p_type")).otherwise(F.array("p_brand")).alias("images"),
    )
    return old, new


_DIFF_SQL = """
WITH o AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS a, p_type AS b, CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS c,
    CAST(p_retailprice AS DECIMAL(10,2)) AS d, [p_brand] AS e FROM part),
n AS (
  SELECT CAST(CASE WHEN p_partkey % 13 = 0 THEN -p_partkey - 1 ELSE p_partkey END AS VARCHAR) AS id,
    CASE WHEN p_partkey % 17 = 0 THEN upper(p_name) ELSE p_name END AS a, p_type AS b,
    CASE WHEN p_partkey % 10 <> 0 THEN p_size END AS c,
    CAST(CASE WHEN p_partkey % 7 = 0 THEN p_retailprice + 1 WHEN p_partkey % 11 <> 0 THEN p_retailprice END AS DECIMAL(10,2)) AS d,
    CASE WHEN p_partkey % 19 = 0 THEN [p_brand, p_type] ELSE [p_brand] END AS e FROM part)
SELECT * FROM (
  SELECT n.id AS feed_provider_id, n.a AS property_name, concat_ws(',',
    CASE WHEN o.a IS DISTINCT FROM n.a THEN 'property_name' END, CASE WHEN o.b IS DISTINCT FROM n.b THEN 'property_type' END,
    CASE WHEN o.c IS DISTINCT FROM n.c THEN 'occupancy' END, CASE WHEN o.d IS DISTINCT FROM n.d THEN 'price' END,
    CASE WHEN o.e IS DISTINCT FROM n.e THEN 'images' END) AS changed_fields
  FROM o JOIN n ON o.id = n.id)
"""


def _joined_fields(diff: DataFrame) -> DataFrame:
    return diff.withColumn("changed_fields", F.array_join("changed_fields", ","))


@query("snapshot_diff", _DIFF_SQL + " WHERE changed_fields <> ''")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that changed between two versions, per key in both."""
    return _joined_fields(diff_versions(*_part_versions(spark, sf_dir), columns=_PART_COLUMNS))


@query("snapshot_diff_all", _DIFF_SQL)
def snapshot_diff_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with unchanged rows."""
    return _joined_fields(diff_versions(*_part_versions(spark, sf_dir), columns=_PART_COLUMNS, include_unchanged=True))


@query("versioned_diff", _DIFF_SQL + " WHERE changed_fields <> ''")
def versioned_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over two versions written to and read from a versioned table."""
    old, new = _part_versions(spark, sf_dir)
    versions = VersionedTable(spark, scratch(spark), old.schema)
    first, second = versions.write(old), versions.write(new)
    return _joined_fields(diff_versions(versions.read(first), versions.read(second), columns=_PART_COLUMNS))


@query(
    "versioned_diff_default",
    f"""WITH {LISTING_SQL}, f AS (SELECT feed_provider_id, property_name, concat_ws(',', CASE WHEN k % 9 = 4 THEN 'property_name' END,
        CASE WHEN k % 10 = 1 THEN 'city' END, CASE WHEN k % 8 = 0 AND star_rating IS NOT NULL THEN 'star_rating' END,
        CASE WHEN k % 6 = 0 AND price IS NOT NULL THEN 'price' END, CASE WHEN k % 4 = 1 THEN 'images' END,
        CASE WHEN k % 7 = 2 THEN 'is_published' END) AS changed_fields, k FROM listing WHERE k % 13 <> 5)
    SELECT feed_provider_id, CASE WHEN k % 9 = 4 THEN property_name || '!' ELSE property_name END AS property_name, changed_fields
    FROM f WHERE changed_fields <> ''""",
)
def versioned_diff_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All compared columns of two versions of the listing table; texts that are not compared change in every row."""
    old, k = listing_rows(spark, sf_dir), F.col("feed_provider_id").cast("bigint")
    later = {
        "property_name": F.when(k % 9 == 4, F.concat("property_name", F.lit("!"))).otherwise(F.col("property_name")),
        "city": F.when(k % 10 == 1, F.concat("city", F.lit("?"))).otherwise(F.col("city")),
        "star_rating": F.when(k % 8 != 0, F.col("star_rating")),
        "price": F.when(k % 6 == 0, (F.col("price") + 1).cast("decimal(10,2)")).otherwise(F.col("price")),
        "images": F.when(k % 4 == 1, F.concat("images", F.array(F.lit("new.jpg")))).otherwise(F.col("images")),
        "is_published": F.when(k % 7 == 2, ~F.col("is_published")).otherwise(F.col("is_published")),
        "raw_data": F.lit("later"),
    }
    versions = VersionedTable(spark, scratch(spark))
    first, second = versions.write(old), versions.write(old.withColumns(later).where(k % 13 != 5))
    return _joined_fields(diff_wide_versions(versions.read(first), versions.read(second)))


# --- merge ----------------------------------------------------------------------------------


def _staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged listing rows from orders: several per customer, with blanks, NULLs and new keys."""
    o = F.col("o_orderkey")
    owner = F.when(F.col("o_custkey") % 10 == 0, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey"))
    rows = table(spark, sf_dir, "orders").select(
        owner.cast("string").alias("feed_provider_id"),
        F.concat(F.lit("BC-"), owner.cast("string")).alias("external_id"),
        F.when(o % 3 != 0, F.concat(F.lit("Stay "), "o_orderpriority")).otherwise("").alias("property_name"),
        F.when(o % 4 != 0, F.col("o_totalprice")).cast("decimal(10,2)").alias("price"),
        F.when(o % 5 == 0, "EUR").when(o % 5 == 1, "").alias("currency"),
        F.when(o % 6 != 0, (o % 50)).cast("int").alias("number_of_review"),
        F.when(o % 2 == 0, (1 + o % 4)).cast("int").alias("min_stay"),
        F.when(o % 7 == 0, F.array().cast("array<string>")).when(o % 7 != 1, F.array("o_orderstatus", "o_orderpriority")).alias("images"),
        F.when(o % 8 == 0, "{}").when(o % 8 != 1, F.concat(F.lit('{"n": '), (o % 8).cast("string"), F.lit("}"))).alias("policy"),
        F.when(o % 9 == 0, "[]").otherwise(F.concat(F.lit('["'), "o_orderstatus", F.lit('"]'))).alias("feature_summary"),
        F.when(o % 3 == 1, F.col("o_orderstatus") == "O").alias("is_published"),
        F.concat(F.lit('{"order": '), o.cast("string"), F.lit("}")).alias("raw_data"),
        F.col("o_orderdate").alias("_at"),
        o.alias("_o"),
    )
    return keep_last(rows, ["feed_provider_id"], ["_at", "_o"]).drop("_at", "_o")


_MERGED = (
    "feed_provider_id external_id property_name city price currency number_of_review min_stay policy feature_summary is_published raw_data"
).split()


def _merge(spark: SparkSession, sf_dir: str, broadcast_rows: int) -> DataFrame:
    current = listing_rows(spark, sf_dir)
    merged = merge_keyed(
        current,
        _staged_orders(spark, sf_dir),
        schemas.LISTING_KEY,
        LISTING_RULES,
        F.timestamp_seconds(F.lit(1767225600)),
        UPDATE_DEFAULTS,
        INSERT_DEFAULTS,
        broadcast_rows,
    )
    texts = {c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("created_at", "last_synced_at")}
    return merged.select(
        *[F.col(c).cast("double").alias(c) if c == "price" else F.col(c) for c in _MERGED if c != "policy"],
        F.when(F.col("policy").contains("pets_allowed"), "stored").otherwise(F.col("policy")).alias("policy"),
        F.coalesce(F.array_join("images", "|"), F.lit("(null)")).alias("images"),
        *[c.alias(n) for n, c in texts.items()],
    )


_STAGED_SQL = """
staged AS (
  SELECT * FROM (
    SELECT CAST(owner AS VARCHAR) AS id, 'BC-' || owner AS external_id,
      CASE WHEN o % 3 <> 0 THEN 'Stay ' || o_orderpriority ELSE '' END AS property_name,
      CASE WHEN o % 4 <> 0 THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS price,
      CASE WHEN o % 5 = 0 THEN 'EUR' WHEN o % 5 = 1 THEN '' END AS currency,
      CASE WHEN o % 6 <> 0 THEN CAST(o % 50 AS INTEGER) END AS number_of_review,
      CASE WHEN o % 2 = 0 THEN CAST(1 + o % 4 AS INTEGER) END AS min_stay,
      CASE WHEN o % 7 = 0 THEN CAST([] AS VARCHAR[]) WHEN o % 7 <> 1 THEN [o_orderstatus, o_orderpriority] END AS images,
      CASE WHEN o % 8 = 0 THEN '{}' WHEN o % 8 <> 1 THEN '{"n": ' || (o % 8) || '}' END AS policy,
      CASE WHEN o % 9 = 0 THEN '[]' ELSE '["' || o_orderstatus || '"]' END AS feature_summary,
      CASE WHEN o % 3 = 1 THEN o_orderstatus = 'O' END AS is_published, '{"order": ' || o || '}' AS raw_data,
      row_number() OVER (PARTITION BY owner ORDER BY o_orderdate DESC, o DESC) AS rn
    FROM (SELECT *, o_orderkey AS o, CASE WHEN o_custkey % 10 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS owner FROM orders))
  WHERE rn = 1)
"""

_MERGE_SQL = f"""
WITH {LISTING_SQL}, {_STAGED_SQL}
SELECT coalesce(t.feed_provider_id, s.id) AS feed_provider_id,
  CASE WHEN t.k IS NULL THEN s.external_id ELSE coalesce(nullif(s.external_id, ''), t.external_id) END AS external_id,
  CASE WHEN t.k IS NULL THEN s.property_name ELSE coalesce(nullif(s.property_name, ''), t.property_name) END AS property_name,
  t.city,
  CAST(coalesce(s.price, t.price) AS DOUBLE) AS price,
  CASE WHEN t.k IS NULL THEN coalesce(s.currency, 'USD') ELSE coalesce(nullif(s.currency, ''), 'USD') END AS currency,
  CASE WHEN t.k IS NULL THEN coalesce(s.number_of_review, 0) ELSE coalesce(s.number_of_review, t.number_of_review, 0) END AS number_of_review,
  CASE WHEN t.k IS NULL THEN coalesce(s.min_stay, 1) ELSE coalesce(s.min_stay, t.min_stay, 1) END AS min_stay,
  CASE WHEN t.k IS NULL THEN s.policy ELSE coalesce(nullif(s.policy, '{{}}'), 'stored') END AS policy,
  CASE WHEN t.k IS NULL THEN s.feature_summary ELSE coalesce(nullif(s.feature_summary, '[]'), '[]') END AS feature_summary,
  CASE WHEN t.k IS NULL THEN coalesce(s.is_published, true) ELSE coalesce(s.is_published, t.is_published) END AS is_published,
  CASE WHEN t.k IS NULL THEN s.raw_data ELSE '{{}}' END AS raw_data,
  coalesce(array_to_string(CASE WHEN s.id IS NULL OR (t.k IS NOT NULL AND len(s.images) = 0) THEN t.images ELSE s.images END, '|'), '(null)') AS images,
  strftime(CASE WHEN t.k IS NULL THEN TIMESTAMP '2026-01-01' ELSE t.synced END, '%Y-%m-%d %H:%M') AS created_at,
  strftime(CASE WHEN s.id IS NOT NULL THEN TIMESTAMP '2026-01-01' ELSE t.synced END, '%Y-%m-%d %H:%M') AS last_synced_at
FROM listing t FULL JOIN staged s ON t.feed_provider_id = s.id
"""


@query("merge_upsert", _MERGE_SQL)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed merge with all rule kinds; the staged side is broadcast while it is small."""
    return _merge(spark, sf_dir, 200_000)


@query("merge_upsert_shuffled", _MERGE_SQL)
def merge_upsert_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge by a full outer join, as a large staged side takes it."""
    return _merge(spark, sf_dir, 0)


@query(
    "run_summary",
    f"""WITH {_STAGED_SQL}
    SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS created, count(*) FILTER (WHERE c_custkey IS NOT NULL) AS updated
    FROM staged LEFT JOIN customer ON id = CAST(c_custkey AS VARCHAR)""",
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created and updated keys of that merge."""
    return merge_counts(listing_rows(spark, sf_dir), _staged_orders(spark, sf_dir), schemas.LISTING_KEY)


@query(
    "schema_evolution",
    """SELECT CAST(s_suppkey AS VARCHAR) AS feed_provider_id, s_name AS property_name, CAST(NULL AS INTEGER) AS star_rating,
      CAST(NULL AS VARCHAR) AS policy, true AS no_images FROM supplier
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, CASE WHEN c_custkey % 9 <> 0 THEN CAST(1 + c_custkey % 5 AS INTEGER) END,
      'set', false FROM customer""",
)
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old table without most columns, evolved and united with a current one."""
    old = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("feed_provider_id"), F.col("s_name").alias("property_name")
    )
    both = evolve(old, schemas.LISTING_SCHEMA).unionByName(listing_rows(spark, sf_dir))
    policy = F.when(F.col("policy").isNotNull(), "set").alias("policy")
    return both.select("feed_provider_id", "property_name", "star_rating", policy, F.col("images").isNull().alias("no_images"))


@query(
    "replace_by_key",
    """SELECT c_custkey AS id, 'stored' AS origin FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
    UNION ALL SELECT user_id, max(event_type) FROM events GROUP BY user_id""",
)
def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row upsert by key."""
    stored = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit("stored").alias("origin"))
    fresh = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(F.max("event_type").alias("origin"))
    return replace_keyed(stored, fresh, ["id"])


# --- filters and de-duplication -------------------------------------------------------------


def _event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kinds = [events.where(F.col("event_type") == kind).select(F.col("user_id").alias("id")) for kind in ("view", "signup")]
    return id_union(*kinds)


_RELEVANT_SQL = "(SELECT user_id FROM events WHERE event_type = 'view' UNION SELECT user_id FROM events WHERE event_type = 'signup')"


@query("changelog_semi_join", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN {_RELEVANT_SQL}")
def changelog_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id changed or opened."""
    return keep_ids(table(spark, sf_dir, "customer"), _event_ids(spark, sf_dir), "c_custkey").select("c_custkey", "c_name")


@query("changelog_skipped", f"SELECT count(*) AS skipped FROM customer WHERE c_custkey NOT IN {_RELEVANT_SQL}")
def changelog_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of rows outside the changelog."""
    dropped = drop_ids(table(spark, sf_dir, "customer"), _event_ids(spark, sf_dir), "c_custkey")
    return dropped.agg(F.count("*").alias("skipped"))


@query("relevant_id_union", f"SELECT user_id AS id FROM {_RELEVANT_SQL}")
def relevant_id_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct union of two id lists."""
    return _event_ids(spark, sf_dir)


_ALL_COLUMNS = (
    "l_shipdate l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
).split()


@query(
    "last_wins_dedup",
    f"""SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_partkey, l_suppkey, l_linenumber, l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(c + " DESC" for c in _ALL_COLUMNS)}) AS rn FROM lineitem)
    WHERE rn = 1""",
)
def last_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last row per key in a full order."""
    last = keep_last(table(spark, sf_dir, "lineitem"), ["l_orderkey"], _ALL_COLUMNS)
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")
    return last.select("l_orderkey", shipped, "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@query(
    "price_map",
    f"""WITH p AS (
      SELECT l_orderkey, 'CUR-' || l_linestatus AS currency, l_extendedprice AS price, l_returnflag = 'R' AS free_cancellation,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, strftime(l_shipdate, '%Y-%m-%d') DESC,
          l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
    SELECT o_orderkey, coalesce(currency, 'USD') AS currency, price, coalesce(free_cancellation, false) AS free_cancellation
    FROM orders LEFT JOIN p ON o_orderkey = l_orderkey AND rn = 1""",
)
def price_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price map of search records (last record per id), joined to every order."""
    cancellation = F.when(F.col("l_returnflag") == "R", "free_cancellation").otherwise("none")
    product = F.struct(F.struct(F.struct(cancellation.alias("type")).alias("cancellation")).alias("policies"))
    records = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.struct(F.concat(F.lit("CUR-"), "l_linestatus").alias("booker")).alias("currency"),
        F.struct(F.struct(F.col("l_extendedprice").cast("string").alias("booker_currency")).alias("base")).alias("price"),
        F.array(product).alias("products"),
        F.col("l_linenumber").alias("_bucket"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("_file"),
        F.struct("l_partkey", "l_suppkey", "l_extendedprice").alias("_pos"),
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    joined = orders.join(price_map(records), "id", "left")
    return joined.select(
        F.col("id").alias("o_orderkey"),
        F.coalesce("currency", F.lit("USD")).alias("currency"),
        "price",
        F.coalesce("free_cancellation", F.lit(False)).alias("free_cancellation"),
    )


@query("published_ids", f"WITH {LISTING_SQL} SELECT external_id FROM listing WHERE is_published")
def all_published_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all published listings."""
    return published_ids(listing_rows(spark, sf_dir))


@query(
    "published_sitemap_rows",
    f"""WITH {LISTING_SQL} SELECT external_id, property_slug, strftime(synced, '%Y-%m-%d %H:%M:%S') AS synced,
      feature_image, array_to_string(images, ' ') AS images FROM listing WHERE is_published""",
)
def published_sitemap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sitemap scan: five columns of published rows."""
    rows = sitemap_rows(listing_rows(spark, sf_dir))
    synced = F.date_format("last_synced_at", "yyyy-MM-dd HH:mm:ss").alias("synced")
    return rows.select("external_id", "property_slug", synced, "feature_image", F.array_join("images", " ").alias("images"))
