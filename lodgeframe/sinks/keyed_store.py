"""A Parquet store with whole-row upsert by key: search documents, history items, vector points."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe.operators.dedup import keep_last
from lodgeframe.session import broadcast_if_small
from lodgeframe.sources.paths import CommitLog

BUCKETS = 256
COMPACT_AFTER = 32


class KeyedStore:
    """A base and the changes since, each one committed folder; the newest row of a key counts.

    An upsert appends a folder of its own rows and commits it, so it writes in proportion to them, readers see all of
    it or nothing, and a replayed batch adds rows that change nothing. After ``compact_after`` changes the store is
    compacted: the newest rows become the next base. Folders are never changed; those before a base may be removed
    once nobody reads them.

    Rows carry the bucket of a hash of the first key column and are sorted by it, so that a lookup reads only the
    parts of files that hold its buckets. The number of buckets is fixed by the first commit.
    """

    def __init__(
        self, spark: SparkSession, root: str, keys: list[str], schema: T.StructType, buckets: int = BUCKETS, compact_after: int = COMPACT_AFTER
    ):
        self.spark, self.root, self.keys, self.schema = spark, root.rstrip("/"), keys, schema
        self.log, self.compact_after = CommitLog(spark, self.root), compact_after
        numbers = self.log.numbers()
        self.buckets = json.loads(self.log.text(numbers[0]))["buckets"] if numbers else buckets

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _parts(self) -> list[tuple[int, str]]:
        """(number, folder) from the newest base on."""
        parts = []
        for number in reversed(self.log.numbers()):
            entry = json.loads(self.log.text(number))
            parts.append((number, entry["folder"]))
            if entry["base"]:
                break
        return parts[::-1]

    def _rows(self, wanted: list[int] | None = None) -> DataFrame:
        layout = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], self.schema)

        def load(folder: str) -> DataFrame:
            rows = self.spark.read.schema(layout).parquet(f"{self.root}/{folder}")
            return rows if wanted is None else rows.where(F.col("bucket").isin(wanted))

        base, *changes = [(number, load(folder)) for number, folder in parts]
        if not changes:
            return base[1].drop("bucket")
        newer = changes[0][1].withColumn("_number", F.lit(changes[0][0]))
        for number, rows in changes[1:]:
            newer = newer.unionByName(rows.withColumn("_number", F.lit(number)))
        # The base is read in place; of the changes the last row of a key counts.
        newest = keep_last(newer, self.keys, ["_number"]).drop("_number")
        changed = broadcast_if_small(newer.select(*self.keys).distinct())
        same = [F.col(f"b.{k}").eqNullSafe(F.col(f"c.{k}")) for k in self.keys]
        kept = base[1].alias("b").join(changed.alias("c"), same, "left_anti")
        return kept.unionByName(newest.select(*kept.columns)).drop("bucket")

    def read(self) -> DataFrame:
        return self._rows()

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys. ``keys`` may carry a leading part of the key columns."""
        wanted = None
        if self.keys[0] in keys.columns:
            wanted = [r[0] for r in keys.select(self._bucket(self.keys[0])).distinct().collect()]  # at most `buckets` values
        return self._rows(wanted).join(keys, keys.columns, "left_semi")

    def _append(self, rows: DataFrame, base: bool) -> None:
        folder = f"data/{os.urandom(8).hex()}"
        placed = rows.select(*self.schema.names).withColumn("bucket", self._bucket(self.keys[0]))
        if base:
            placed = placed.repartitionByRange("bucket", *self.keys)  # a bucket may be many tasks
        placed.sortWithinPartitions("bucket", *self.keys).write.parquet(f"{self.root}/{folder}")
        number = max(self.log.numbers(), default=0) + 1
        entry = json.dumps({"folder": folder, "base": base, "buckets": self.buckets})
        while True:
            try:
                return self.log.commit(number, entry)
            except FileExistsError:
                if base:  # rows that came meanwhile are not in this base
                    return None
                number += 1

    def upsert(self, rows: DataFrame) -> None:
        """Replace or add ``rows``; one row per key."""
        parts = self._parts()
        self._append(rows, base=not parts)
        if len(parts) >= self.compact_after:
            self.compact()

    def compact(self) -> None:
        """Write the newest rows as the next base; given up if another writer commits meanwhile."""
        number = max(self.log.numbers(), default=0)
        rows = self._rows()
        if number and max(self.log.numbers()) == number:
            self._append(rows, base=True)
