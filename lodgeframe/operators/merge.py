"""Keyed merge in which an empty incoming value never replaces a known one."""

from __future__ import annotations

from collections.abc import Mapping
from enum import Enum
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe import schemas
from lodgeframe.session import BROADCAST_ROW_LIMIT, at_most, broadcast_if_small
from lodgeframe.sources.tables import evolve


class Keep(Enum):
    """When the stored value survives an update."""

    BLANK = "incoming text is NULL or empty"
    NULL = "incoming value is NULL"
    EMPTY_LIST = "incoming list has no elements; a NULL list does replace"
    EMPTY_OBJECT = "incoming JSON text is NULL or {}"
    EMPTY_ARRAY = "incoming JSON text is NULL or []"
    ALWAYS = "the stored value is never updated"
    NEVER = "the merge time replaces it every time"


_EMPTY_TEXT = {Keep.BLANK: "", Keep.EMPTY_OBJECT: "{}", Keep.EMPTY_ARRAY: "[]"}

# Which rule applies to which column, and the defaults of update and insert.
LISTING_RULES: dict[str, Keep] = {
    **dict.fromkeys(
        "external_id feed_provider_url property_name property_slug property_type property_type_category city "
        "country country_code location_display partner_location_id latlon language currency feature_image "
        "other_policy property_description".split(),
        Keep.BLANK,
    ),
    **dict.fromkeys(
        "feed star_rating review_score review_score_general number_of_review bedroom_count bathroom_count "
        "occupancy max_occupancy price min_stay family_friendly group_friendly is_published".split(),
        Keep.NULL,
    ),
    **dict.fromkeys("images amenities amenity_categories".split(), Keep.EMPTY_LIST),
    **dict.fromkeys("policy property_flags".split(), Keep.EMPTY_OBJECT),
    "feature_summary": Keep.EMPTY_ARRAY,
    **dict.fromkeys("source_created_at created_at raw_data".split(), Keep.ALWAYS),
    **dict.fromkeys("source_updated_at last_synced_at".split(), Keep.NEVER),
}
UPDATE_DEFAULTS: dict[str, Any] = {"number_of_review": 0, "min_stay": 1, "currency": "USD"}
INSERT_DEFAULTS: dict[str, Any] = {"number_of_review": 0, "min_stay": 1, "currency": "USD", "is_published": True}


def _updated(rule: Keep, new: Column, old: Column, default: Any, now: Column) -> Column:
    if rule is Keep.ALWAYS:
        return old
    if rule is Keep.NEVER:
        return now
    if rule is Keep.EMPTY_LIST:
        return F.when(F.size(new) == 0, old).otherwise(new)
    if rule in _EMPTY_TEXT:
        new = F.nullif(new, F.lit(_EMPTY_TEXT[rule]))
    return F.coalesce(new, old) if default is None else F.coalesce(new, old, F.lit(default))


def _inserted(name: str, new: Column, default: Any) -> Column:
    return new if default is None else F.coalesce(new, F.lit(default))


def merge_keyed(
    current: DataFrame,
    staged: DataFrame,
    key: str,
    rules: Mapping[str, Keep],
    merge_ts: Column,
    update_defaults: Mapping[str, Any] | None = None,
    insert_defaults: Mapping[str, Any] | None = None,
    broadcast_rows: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Upsert ``staged`` (one row per key) into ``current``; columns and types are those of ``current``.

    Keys that are NULL match nothing, as in SQL. Of a staged side of at most ``broadcast_rows`` rows the
    keys alone are broadcast, so stored rows that it does not touch are read in place and never shuffled;
    a larger one is merged by one full outer join on the key.
    """
    update_defaults, insert_defaults = update_defaults or {}, insert_defaults or {}
    fields = current.schema.fields
    incoming = set(staged.columns)

    def staged_column(f: T.StructField) -> Column:
        if f.name in incoming:
            return F.col(f"s.{f.name}").cast(f.dataType)
        return F.lit(None).cast(f.dataType)

    def update(f: T.StructField) -> Column:
        if f.name == key:
            return F.col(f"t.{key}")
        new = _updated(rules[f.name], staged_column(f), F.col(f"t.{f.name}"), update_defaults.get(f.name), merge_ts)
        return new.cast(f.dataType)

    def insert(f: T.StructField) -> Column:
        # Times are set on insert whether or not they are refreshed later.
        if isinstance(f.dataType, T.TimestampType) and rules.get(f.name) in (Keep.ALWAYS, Keep.NEVER):
            return merge_ts.cast(f.dataType)
        return _inserted(f.name, staged_column(f), insert_defaults.get(f.name)).cast(f.dataType)

    target = current.withColumn("_stored", F.lit(True)).alias("t")
    source = staged.withColumn("_staged", F.lit(True)).alias("s")
    on = F.col(f"t.{key}") == F.col(f"s.{key}")
    staged_hit, stored_hit = F.col("s._staged").isNotNull(), F.col("t._stored").isNotNull()

    def stored_side(f: T.StructField) -> Column:
        return F.when(staged_hit, update(f)).otherwise(F.col(f"t.{f.name}"))

    if at_most(staged.select(key), broadcast_rows):
        # Only keys are broadcast: rows that no staged key touches are passed on in place, the few others are joined.
        keys = F.broadcast(staged.select(key).where(F.col(key).isNotNull()))
        untouched = current.join(keys, key, "left_anti").select(*[f.name for f in fields])
        touched = current.join(keys, key, "left_semi").withColumn("_stored", F.lit(True)).alias("t")
        rows = touched.join(source, on, "right").select(*[F.when(stored_hit, update(f)).otherwise(insert(f)).alias(f.name) for f in fields])
        return untouched.unionByName(rows)

    merged = [F.when(stored_hit, stored_side(f)).otherwise(insert(f)).alias(f.name) for f in fields]
    return target.join(source, on, "full_outer").select(*merged)


def merge_listings(current: DataFrame, staged: DataFrame, merge_ts: Column) -> DataFrame:
    """The listing table after one sync; ``staged`` holds one row per key."""
    return merge_keyed(
        evolve(current, schemas.LISTING_SCHEMA).select(*schemas.LISTING_COLUMNS),
        staged,
        schemas.LISTING_KEY,
        LISTING_RULES,
        merge_ts,
        UPDATE_DEFAULTS,
        INSERT_DEFAULTS,
    )


def replace_keyed(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-row upsert: incoming rows, and the stored rows whose key is not among them."""
    untouched = current.join(incoming.select(*keys), keys, "left_anti")
    return untouched.unionByName(incoming.select(*current.columns))


def merge_counts(current: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """One row ``(created, updated)``: staged keys that are new, and those already stored."""
    keys = staged.select(key)
    wanted = keys.where(F.col(key).isNotNull()).distinct()
    # The stored keys are met by the staged ones, so that only those of staged rows are ever grouped.
    found = current.select(F.col(key).alias("_k")).join(broadcast_if_small(wanted), F.col("_k") == F.col(key), "left_semi").distinct()
    joined = keys.join(found, F.col(key) == F.col("_k"), "left")
    return joined.agg(F.count_if(F.col("_k").isNull()).alias("created"), F.count_if(F.col("_k").isNotNull()).alias("updated"))
