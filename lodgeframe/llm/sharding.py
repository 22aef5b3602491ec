"""Two-pass external shuffle into shards of equal counts.

Pass one scatters records uniformly by a seeded hash into buckets that fit in a task's memory. Pass two shuffles
each bucket by Fisher-Yates with a seed of its own and writes it. Buckets one after another are a random order of
all rows; cut into equal runs it gives shards whose counts differ by one at most (law ``rows``).

The hash spans key, text and a number for the row, so that neither equal keys nor groups of copies share a bucket.
Positions come from one count per bucket, so no task sees more than its bucket.

Style: one ``applyInArrow`` over buckets of bounded size; all else are DataFrame functions. Shuffled buckets are
written to the cluster's shared folder and read back: a lost executor repeats buckets, never the scatter's numbering.

Defined results: a NULL text has size 1 and the crc of the empty text; NULL and repeated keys are rows like others.
Columns of the input are kept unless they bear the name of a result. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BYTES = 32 << 20
SEED = 20_240_229
PARTS = ("law", "shard", "slot", "grown_shard")


def _fisher_yates(n: int, seed: int) -> np.ndarray:
    """A random order of n places: each place, from the last down, swaps with one drawn from those up to it."""
    order = np.arange(n)
    draws = np.random.default_rng(seed).integers(0, np.arange(n, 0, -1)) if n else order
    swaps = order.tolist()
    for i, j in zip(range(n - 1, 0, -1), draws.tolist()):
        swaps[i], swaps[j] = swaps[j], swaps[i]
    return np.array(swaps, np.int64)


def scatter(docs: DataFrame, key: str, text: str, buckets: int, seed: int) -> DataFrame:
    """``docs`` with ``_bucket``; the row's number spreads rows that are alike in key and text."""
    number = F.monotonically_increasing_id()
    return docs.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text), number), F.lit(buckets)).cast("int"))


def shuffle_buckets(scattered: DataFrame, seed: int) -> DataFrame:
    """Every bucket in a random order: adds ``_place``, from 0 in each bucket."""
    schema = T.StructType([*scattered.schema.fields, T.StructField("_place", T.LongType())])
    columns = scattered.columns

    def run(rows: pa.Table) -> pa.Table:
        bucket = rows.column("_bucket")[0].as_py()
        order = _fisher_yates(rows.num_rows, zlib.crc32(f"{seed}/{bucket}".encode()))
        return rows.select(columns).take(pa.array(order)).append_column("_place", pa.array(np.arange(rows.num_rows)))

    return scattered.groupBy("_bucket").applyInArrow(run, schema)


def shuffle_into_shards(
    docs: DataFrame, path: str, shards: int = 16, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Write ``docs`` in random order to ``path``, one folder per shard range of buckets, and return them as read back.

    Adds size (UTF-8 bytes and 1), text_crc32, law, shard, slot (gapless from 0 in each shard, the order of reading)
    and grown_shard, which is NULL under this law.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    kept = docs.drop("_bucket", "_place", "size", "text_crc32", *PARTS)
    sized = kept.withColumns({"size": F.octet_length(whole).cast("bigint") + 1, "text_crc32": F.crc32(whole)})
    total = sized.agg(F.sum("size").alias("bytes")).first()["bytes"] or 0
    buckets = max(1, -(-total // bucket_bytes))
    shuffled = shuffle_buckets(scatter(sized, key, text, buckets, seed), seed)
    shuffled.write.mode("overwrite").parquet(path)
    written = spark.read.schema(shuffled.schema).parquet(path)
    return number_rows(written, shards)


def number_rows(written: DataFrame, shards: int) -> DataFrame:
    """Shard and slot from bucket and place. There is one count for each bucket, hence one for each ``bucket_bytes`` of
    the data: at 100 TB some millions of small rows, summed up in two levels and joined by bucket."""
    from pyspark.sql import Window

    counts = written.groupBy("_bucket").agg(F.count("*").alias("n")).withColumn("run", F.floor(F.col("_bucket") / 4096))
    inside = Window.partitionBy("run").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.groupBy("run").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    starts = runs.select("run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"), F.sum("rows").over(every).alias("total"))
    offsets = counts.join(starts, "run").select("_bucket", (F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first"), "total")
    place = F.col("first") + F.col("_place")
    least, longer = F.floor(F.col("total") / shards), F.col("total") % shards
    # The first ``longer`` shards hold one row more than the others.
    head = longer * (least + 1)
    shard = F.when(place < head, F.floor(place / (least + 1))).otherwise(longer + F.floor((place - head) / F.greatest(least, F.lit(1))))
    slot = F.when(place < head, place % (least + 1)).otherwise((place - head) % F.greatest(least, F.lit(1)))
    numbered = written.join(offsets, "_bucket").withColumns(
        {"law": F.lit("rows"), "shard": shard.cast("int"), "slot": slot.cast("bigint"), "grown_shard": F.lit(None).cast("int")}
    )
    return numbered.drop("_bucket", "_place", "first", "total")
