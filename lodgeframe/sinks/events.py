"""Change events: which keys a sync touched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe import schemas

# Keys per event row. A day's keys are spread over as many rows as they need.
KEYS_PER_EVENT = 10_000


def publish_change_event(keys: DataFrame, day: str, events_root: str, keys_per_event: int = KEYS_PER_EVENT) -> None:
    """Append JSON events ``{"date", "feed_provider_ids"}`` to a folder; no keys, no event.

    Keys are packed inside each task in bounded lists, so no list holds the whole day.
    """
    column = F.col(schemas.LISTING_KEY)
    # A generated id counts up within a task, so its quotient numbers the lists of that task.
    chunk = F.floor(F.monotonically_increasing_id() / keys_per_event)
    packed = (
        keys.where(column.isNotNull())
        .withColumn("_chunk", chunk)
        .groupBy("_chunk")
        .agg(F.collect_list(column).alias("feed_provider_ids"))
        .select(F.lit(day).alias("date"), "feed_provider_ids")
    )
    if not packed.isEmpty():
        packed.write.mode("append").json(events_root)
