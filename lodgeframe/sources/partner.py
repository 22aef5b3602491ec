"""Partner listing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.session import handed_over, text_reading


def partner_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a partner file: a flat list, or a list under ``properties`` or else ``data``.

    ``latlon`` becomes text, so objects and EWKT text both survive until they are parsed. The files are read once, into
    reliable storage.
    """
    names = spark.createDataFrame([], schemas.PARTNER_ROW_DDL).columns
    row = ", ".join(f"{n}: string" for n in names)
    ddl = f"{schemas.PARTNER_ROW_DDL}, properties array<struct<{row}>>, data array<struct<{row}>>"
    read = text_reading(spark).read.schema(ddl).option("multiLine", True).json(path)
    wrapped = F.coalesce("properties", "data")
    # A flat row is a list of its own, so that one scan gives all shapes.
    own = F.when(F.coalesce(*names).isNotNull(), F.array(F.struct(*names))).otherwise(F.array().cast(f"array<struct<{row}>>"))
    return handed_over(spark, read.select(F.inline(F.coalesce(wrapped, own))))
