"""Versioned listing tables on Parquet and scans over them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe import schemas
from lodgeframe.sources.paths import CommitLog, matches


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` that ``df`` lacks are added as typed NULLs; others stay as they are."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


class VersionedTable:
    """A Parquet table kept as one folder per version.

    A version counts once it is committed, so a job that dies half-way leaves no readable version behind; of two that
    claim the same number the second fails. The version being read is never overwritten.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = schemas.LISTING_SCHEMA):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.log = CommitLog(spark, self.root)

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        return self.log.numbers()

    def read(self, version: int | None = None) -> DataFrame:
        """One version (the newest by default), with columns added since it was written."""
        known = self.versions()
        if version is None and not known:
            return self.spark.createDataFrame([], self.schema)
        chosen = known[-1] if version is None else version
        if chosen not in known:
            raise ValueError(f"no version {chosen} in {self.root}")
        return evolve(self.spark.read.parquet(f"{self.root}/{self.log.text(chosen)}"), self.schema)

    def write(self, df: DataFrame) -> int:
        """Write ``df`` as the next version and return its number; ``FileExistsError`` if another writer took it meanwhile."""
        known = self.versions()
        version = known[-1] + 1 if known else 1
        folder = f"version={version}-{os.urandom(4).hex()}"
        df.write.parquet(f"{self.root}/{folder}")
        self.log.commit(version, folder)
        return version


def published(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_published"))


def sitemap_rows(listings: DataFrame) -> DataFrame:
    """The five sitemap columns of published listings."""
    return published(listings).select("external_id", "property_slug", "last_synced_at", "feature_image", "images")


def comparison_rows(listings: DataFrame) -> DataFrame:
    """The nine columns duplicate detection needs."""
    return listings.select(
        "external_id",
        "latlon",
        "property_name",
        "property_type",
        "location_display",
        "bedroom_count",
        "bathroom_count",
        "property_description",
        "other_policy",
    )


def published_ids(listings: DataFrame) -> DataFrame:
    """Ids of all published listings, without a cap."""
    return published(listings).select("external_id")


def exported_documents(spark: SparkSession, root: str, day: str, schema: T.StructType) -> DataFrame:
    """Exported documents of one date partition; only that partition's files are read."""
    if not matches(spark, f"{root}/date={day}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{root}/date={day}")
