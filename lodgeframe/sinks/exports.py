"""Exports: nested JSON documents, history items, vector points and a hook for outside stores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lodgeframe.operators.dedup import keep_ids, keep_last
from lodgeframe.operators.documents import export_documents, kv_items, skipped_documents, vector_points
from lodgeframe.sinks.keyed_store import KeyedStore


def export_json(listings: DataFrame, root: str, day: str) -> None:
    """Write the export documents of one day under ``root/date=<day>``, replacing that day only."""
    documents = export_documents(listings)
    documents.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root.rstrip('/')}/date={day}")


def latest_items(listings: DataFrame) -> DataFrame:
    """History items of ``listings``; items without a key part are dropped, the last sync of a key wins."""
    items = kv_items(listings, "last_synced_at")
    keyed = items.where((F.coalesce("property_id", F.lit("")) != "") & F.col("timestamp").isNotNull())
    return keep_last(keyed, ["property_id", "timestamp"], ["last_synced_at"]).drop("last_synced_at")


def history_items(listings: DataFrame, ids: DataFrame) -> DataFrame:
    """``latest_items`` of the listings in ``ids.id``."""
    return latest_items(keep_ids(listings, ids, "feed_provider_id"))


def export_history(listings: DataFrame, ids: DataFrame, store: KeyedStore) -> None:
    store.upsert(history_items(listings, ids))


def export_points(documents: DataFrame, vectors: DataFrame, store: KeyedStore) -> int:
    """Upsert the vector points of ``documents``; returns how many documents were skipped for want of id, text or vector."""
    store.upsert(vector_points(documents, vectors))
    return skipped_documents(documents, vectors).count()


def write_partitions(rows: DataFrame, writer: Callable[[Iterator[Row]], None]) -> None:
    """Hand each partition to ``writer`` on the executors, for stores that Spark has no sink for."""
    rows.foreachPartition(writer)
