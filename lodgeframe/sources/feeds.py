"""Dated feed folders: changelog ids, feed files, listing records and search prices."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe import schemas
from lodgeframe.operators.dedup import keep_last
from lodgeframe.session import cut_lineage, handed_over, own_session, text_reading
from lodgeframe.sources.paths import matches

# The record buckets in the order in which later ones win.
BUCKETS = ("changed", "opened")


def changelog_ids(spark: SparkSession, root: str, day: str, kind: str = "changed", prefix: str = "*") -> DataFrame:
    """Ids of one day's changelog as ``(id)``.

    Only the first file by name is read, whatever date its name carries. It holds a flat list or an
    object with the list under its kind.
    """
    files = matches(spark, f"{root}/changelog/{day}/{prefix}_{kind}_*.json")
    if not files:
        return spark.createDataFrame([], "id string")
    split = _split_ids(spark, files[0], kind)
    return split if split is not None else _whole_ids(spark, files[0], kind)


# An element of a list of plain values between two commas, the first perhaps behind the key, the last before the end.
_ELEMENT = r'(?s)^\s*(\{\s*"KIND"\s*:\s*)?(\[)?\s*("(?:[^"\\]|\\.)*"|[^\s"\[\]{}:]+)?\s*(\])?\s*(\})?\s*$'


def _split_ids(spark: SparkSession, file: str, kind: str) -> DataFrame | None:
    """Ids of a list of plain values, one row each, cut at the commas so that many tasks share a file of any size.

    None if the file is anything else: other keys, nested values, a comma inside an id, or no valid JSON.
    """
    element = _ELEMENT.replace("KIND", re.escape(kind))
    rows = spark.read.text(file, lineSep=",")
    parts = [F.regexp_extract("value", element, i).alias(n) for i, n in enumerate(("key", "opens", "id", "closes", "end"), 1)]
    read = rows.select((~F.col("value").rlike(element)).alias("odd"), *parts)
    value = F.from_json(F.concat(F.lit("["), "id", F.lit("]")), "array<string>")
    held = {c: F.count_if(F.col(c) != "").alias(c) for c in ("key", "opens", "closes", "end")}
    empty = F.count_if((F.col("id") == "") & ~((F.col("opens") != "") & (F.col("closes") != ""))).alias("empty")
    misplaced = F.count_if(((F.col("key") != "") & (F.col("opens") == "")) | ((F.col("end") != "") & (F.col("closes") == ""))).alias("misplaced")
    unread = F.count_if((F.col("id") != "") & value.isNull()).alias("unread")
    seen = read.agg(F.count_if("odd").alias("odd"), *held.values(), empty, misplaced, unread, F.count("*").alias("rows")).first()
    if seen["odd"] or seen["empty"] or seen["misplaced"] or seen["unread"] or (seen["opens"], seen["closes"]) != (1, 1) or seen["key"] != seen["end"]:
        return None
    return read.where(F.col("id") != "").select(value[0].alias("id"))


def _whole_ids(spark: SparkSession, file: str, kind: str) -> DataFrame:
    """The same from the whole text as one value, whatever else it holds."""
    text = spark.read.text(file, wholetext=True)
    ids = F.coalesce(
        F.from_json("value", "array<string>"),
        F.from_json(F.get_json_object("value", f"$.{kind}"), "array<string>"),
    )
    return text.select(F.explode(ids).alias("id"))


def relevant_ids(spark: SparkSession, root: str, day: str, prefix: str = "*") -> DataFrame:
    """Distinct ids that changed or opened on ``day``."""
    return id_union(*(changelog_ids(spark, root, day, kind, prefix) for kind in BUCKETS))


def id_union(first: DataFrame, *others: DataFrame) -> DataFrame:
    out = first
    for other in others:
        out = out.unionByName(other)
    return out.distinct()


def feed_files(spark: SparkSession, root: str, feed: str, day: str, bucket: str) -> list[str]:
    """JSON files of one feed, day and bucket, sorted by name; empty if the folder is missing."""
    return matches(spark, f"{root}/{feed}/{day}/{bucket}/*.json")


def _record_order() -> list[Column]:
    # A multi-line JSON file is never split, so the generated id grows in file order within a file.
    return [F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_pos")]


def feed_records(spark: SparkSession, root: str, feed: str, day: str, bucket: str, record_ddl: str) -> DataFrame:
    """Typed records of a feed, whichever of the three file shapes holds them.

    A file is a list of records, one record, or one record under ``rental_property``. Columns are those
    of ``record_ddl`` plus ``_file`` and ``_pos`` for the order of arrival. The files are read once, into reliable storage.
    """
    files = feed_files(spark, root, feed, day, bucket)
    names = spark.createDataFrame([], record_ddl).columns
    if not files:
        return spark.createDataFrame([], f"{record_ddl}, _file string, _pos bigint")
    ddl = f"{record_ddl}, rental_property struct<{_as_struct(spark, record_ddl)}>"
    read = text_reading(spark).read.schema(ddl).option("multiLine", True).json(files).select("*", *_record_order())
    inner = F.col("rental_property")
    picked = [F.when(inner.isNotNull(), inner[n]).otherwise(F.col(n)).alias(n) for n in names]
    return handed_over(spark, read.select(*picked, "_file", "_pos"))


def _as_struct(spark: SparkSession, ddl: str) -> str:
    fields = spark.createDataFrame([], ddl).schema.fields
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in fields)


WRAPPER = "rental_property"
# Holds the text of files that do not parse; no feed has this key.
UNREAD = "_unread_by_lodgeframe"


def _records_by_key(spark: SparkSession, files: list[str]) -> DataFrame:
    """``raw_data``, ``_file``, ``_pos`` of every record, whatever the size of its file; NULL for files that do not parse.

    Spark's reader streams the elements of a list as rows, so only one field of one record must fit in a variant value.
    The keys come from one inference over all files; each is read as a variant, so unknown keys and shapes survive. Keys
    that differ in case only are different keys, in JSON and in a reader of its own whose session tells them apart.
    """
    reading = _telling_case_apart(spark)
    known = spark.createDataFrame([], schemas.RAW_LISTING_DDL).columns
    inferred = reading.read.option("multiLine", True).option("columnNameOfCorruptRecord", UNREAD).json(files).columns
    keys = [k for k in dict.fromkeys([*inferred, *known, WRAPPER]) if k != UNREAD]
    fields = [T.StructField(k, T.VariantType()) for k in keys] + [T.StructField(UNREAD, T.StringType())]
    reader = reading.read.schema(T.StructType(fields)).option("multiLine", True).option("columnNameOfCorruptRecord", UNREAD)
    names = [F.col("`" + k.replace("`", "``") + "`") for k in keys if k != WRAPPER]
    record = F.coalesce(F.to_json(WRAPPER), F.to_json(F.struct(*names)))
    file, position = _record_order()
    read = reader.json(files).select(F.when(F.col(UNREAD).isNull(), record).alias("raw_data"), file, position)
    # Written once, as the caller asks first for the files that do not parse; and so back into the caller's session.
    read = cut_lineage(read)
    return spark.createDataFrame([], "raw_data string, _file string, _pos bigint").unionByName(read)


def _telling_case_apart(spark: SparkSession) -> SparkSession:
    """A session of the same application in which names that differ in case are different; the caller's stays as it is."""
    return own_session(spark, **{"spark.sql.caseSensitive": True})


def _records_by_element(spark: SparkSession, files: list[str]) -> DataFrame:
    """The same for files that hold something else than objects: each file is one variant value, element by element."""
    read = spark.read.option("multiLine", True).option("singleVariantColumn", "doc").json(files)
    elements = F.when(F.expr("is_variant_null(doc) OR doc IS NULL"), F.array(F.lit(None).cast("variant"))).otherwise(
        F.coalesce(F.expr("try_variant_get(doc, '$', 'array<variant>')"), F.array(F.coalesce(F.expr(f"try_variant_get(doc, '$.{WRAPPER}', 'variant')"), F.col("doc"))))
    )
    rows = read.select(F.col("_metadata.file_path").alias("_file"), F.posexplode(elements).alias("_pos", "record"))
    return rows.select(F.to_json("record").alias("raw_data"), "_file", F.col("_pos").cast("bigint").alias("_pos"))


def raw_listings(spark: SparkSession, root: str, day: str, feed: str = "accommodation_details") -> DataFrame:
    """Whole listing records of both buckets: ``raw_data`` (JSON text), ``_bucket``, ``_file``, ``_pos``.

    A file that is not valid JSON yields one row with NULL ``raw_data``, which names it among the rejects. A file in
    which a list holds anything but objects is read element by element, so its records are not lost with it.
    """
    parts = []
    for order, bucket in enumerate(BUCKETS):
        files = feed_files(spark, root, feed, day, bucket)
        if not files:
            continue
        read = _records_by_key(spark, files)
        # Names of files, which the driver lists anyway.
        odd = [r["_file"] for r in read.where(F.col("raw_data").isNull()).select("_file").distinct().collect()]
        if odd:
            read = read.where(~F.col("_file").isin(odd)).unionByName(_records_by_element(spark, odd))
        parts.append(read.withColumn("_bucket", F.lit(order)))
    if not parts:
        return spark.createDataFrame([], "raw_data string, _file string, _pos bigint, _bucket int")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def price_map(search_records: DataFrame) -> DataFrame:
    """One row per id: currency, base price and whether any product can be cancelled freely.

    ``search_records`` carries ``_bucket``, ``_file`` and ``_pos``; the last record of an id wins.
    """
    free = F.exists("products", lambda p: F.coalesce(p["policies"]["cancellation"]["type"] == "free_cancellation", F.lit(False)))
    rows = search_records.where(F.col("id").isNotNull()).select(
        "id",
        F.col("currency.booker").alias("currency"),
        F.col("price.base.booker_currency").try_cast("double").alias("price"),
        F.coalesce(free, F.lit(False)).alias("free_cancellation"),
        "_bucket",
        "_file",
        "_pos",
    )
    return keep_last(rows, ["id"], ["_bucket", "_file", "_pos"]).drop("_bucket", "_file", "_pos")


def search_prices(spark: SparkSession, root: str, day: str) -> DataFrame:
    """Price map of one day's search feed."""
    parts = [
        feed_records(spark, root, "search", day, bucket, schemas.SEARCH_RECORD_DDL).withColumn("_bucket", F.lit(order))
        for order, bucket in enumerate(BUCKETS)
    ]
    return price_map(parts[0].unionByName(parts[1]))
