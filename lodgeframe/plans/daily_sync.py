"""The daily sync: feeds and changelog of one day merged into the listing table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.operators.cleaning import ORDER, assemble_rows, parse_records
from lodgeframe.operators.dedup import keep_last
from lodgeframe.operators.merge import merge_counts, merge_listings
from lodgeframe.session import cut_lineage
from lodgeframe.sinks.events import publish_change_event
from lodgeframe.sources.feeds import raw_listings, relevant_ids, search_prices
from lodgeframe.sources.lookups import load_lookups
from lodgeframe.sources.tables import VersionedTable


@dataclass(frozen=True)
class SyncResult:
    """Counts of one run, the version written (None if nothing was staged), the staged keys and the rejected records."""

    date: str
    created: int
    updated: int
    errors: int
    skipped: int
    version: int | None
    changed: DataFrame
    rejected: DataFrame


def read_day(spark: SparkSession, feed_root: str, day: str) -> DataFrame:
    """All records of one day, read and parsed once and kept on reliable storage.

    ``kind`` is wanted, skipped (not in the changelog) or error (no readable record). Skipped records keep only their
    place, errors their text.
    """
    ids = relevant_ids(spark, feed_root, day).select(F.col("id").alias("_id"), F.lit(True).alias("_hit"))
    records = parse_records(raw_listings(spark, feed_root, day)).withColumn("_id", F.col("r.id")).join(ids, "_id", "left")
    kind = F.when(F.col("r").isNull(), "error").when(F.col("_hit"), "wanted").otherwise("skipped")
    kept = records.withColumn("kind", kind).drop("_id", "_hit")
    skipped = F.col("kind") == "skipped"
    return cut_lineage(kept.withColumns({c: F.when(~skipped, F.col(c)) for c in ("raw_data", "r")}))


def stage_rows(spark: SparkSession, feed_root: str, day: str, records: DataFrame) -> DataFrame:
    """Staged rows of the wanted records, one per key, on reliable storage: merge, counts and event all read them."""
    lookups = load_lookups(spark, feed_root)
    try:
        rows = assemble_rows(records.where("kind = 'wanted'").drop("kind"), search_prices(spark, feed_root, day), lookups)
        return cut_lineage(keep_last(rows, [schemas.LISTING_KEY], ORDER).drop(*ORDER))
    finally:
        lookups.release()


def rejected_records(records: DataFrame) -> DataFrame:
    """(file, reason, raw_data) of what could not be read: whole files by name, and single records with their text."""
    reason = F.when(F.col("raw_data").isNull(), "file is not valid JSON").otherwise("record is not an object")
    return records.where("kind = 'error'").select(F.col("_file").alias("file"), reason.alias("reason"), "raw_data")


def sync_day(
    spark: SparkSession,
    feed_root: str,
    table: VersionedTable,
    day: str,
    sync_ts: datetime,
    events_root: str | None = None,
    rejects_root: str | None = None,
) -> SyncResult:
    """Merge one day's records, write the next version and announce the changed keys.

    Records that are not readable are counted as errors, do not stop the job, and are written with file and reason to
    ``rejects_root/date=<day>`` if that is given.
    """
    records = read_day(spark, feed_root, day)
    dropped = records.agg(F.count_if(F.col("kind") == "error").alias("errors"), F.count_if(F.col("kind") == "skipped").alias("skipped")).first()
    rejected = rejected_records(records)
    if rejects_root and dropped["errors"]:
        rejected.write.mode("overwrite").json(f"{rejects_root.rstrip('/')}/date={day}")
    staged = stage_rows(spark, feed_root, day, records)
    current = table.read()
    counts = merge_counts(current, staged, schemas.LISTING_KEY).first()
    total = counts["created"] + counts["updated"]
    version = None
    changed = staged.select(schemas.LISTING_KEY)
    if total:
        version = table.write(merge_listings(current, staged, F.lit(sync_ts)))
        if events_root:
            publish_change_event(changed, day, events_root)
    return SyncResult(day, counts["created"], counts["updated"], dropped["errors"], dropped["skipped"], version, changed, rejected)
