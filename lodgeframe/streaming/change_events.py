"""Keeps the search documents fresh from change events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodgeframe import schemas
from lodgeframe.operators.dedup import keep_ids
from lodgeframe.operators.documents import search_documents
from lodgeframe.sinks.keyed_store import KeyedStore

MAX_EVENT_FILES = 10


def parse_events(lines: DataFrame) -> DataFrame:
    """``value`` (event text) with ``event``: NULL where the text is no JSON object."""
    parsed = F.from_json("value", f"{schemas.CHANGE_EVENT_DDL}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    # Parsed in a projection of its own, so once for each text and not once for each mention.
    read = lines.select("value", parsed.alias("_parsed"))
    is_object = F.ltrim("value").startswith("{") & F.col("_parsed._bad").isNull()
    return read.select("value", F.when(is_object, F.col("_parsed")).alias("event"))


def event_ids(events: DataFrame) -> DataFrame:
    """Distinct ids named by readable events; a missing list counts as empty."""
    ids = F.explode("event.feed_provider_ids")
    return events.where(F.col("event").isNotNull()).select(ids.alias("id")).where(F.col("id").isNotNull()).distinct()


def run_change_stream(
    spark: SparkSession,
    events_root: str,
    listings: Callable[[], DataFrame],
    store: KeyedStore,
    rejects_root: str,
    checkpoint: str,
    max_files: int = MAX_EVENT_FILES,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream. For every batch of events the named listings are read anew from the table.

    A batch that fails is read again after a restart and replaces the same documents. Events that are
    not readable go to ``rejects_root``, one folder per batch, and do not hold up the stream.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Kept of an event are its ids, or its text if it cannot be read.
        unread = F.col("event").isNull()
        ids = F.when(~unread, F.struct("event.feed_provider_ids"))
        events = parse_events(batch).select(F.when(unread, F.col("value")).alias("value"), ids.alias("event")).persist()
        try:
            rejected = events.where(F.col("event").isNull()).select("value")
            rejected.write.mode("overwrite").json(f"{rejects_root}/batch={batch_id}")
            rows = keep_ids(listings(), event_ids(events), schemas.LISTING_KEY)
            store.upsert(search_documents(rows))
        finally:
            events.unpersist()

    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(events_root)
    writer = lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
