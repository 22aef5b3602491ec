"""Joins whose keys may be hot: the many rows of a hot key are dealt out, the one row that belongs to them is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is dealt out; on large inputs, one with more than this share of all rows.
HOT_ROWS, HOT_SHARE = 5_000, 1e-4


def join_hot(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``many`` joined ("inner" or "left") to the rows of ``one`` with an equal ``key``; ``one`` has few rows a key.

    Keys are counted with a combine before the shuffle. The hot ones, at most 1 / ``HOT_SHARE`` of them, are broadcast with
    their number of parts; a row of ``many`` goes to a part by a hash of its other columns, so that a task which runs
    again deals it out alike. ``many`` must come from files or a checkpoint, as it is read twice.
    """
    total = many.count()
    limit = max(HOT_ROWS, int(total * HOT_SHARE))
    if total <= limit:
        return many.join(one, key, how)
    hot = many.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    hot = hot.select(key, F.ceil(F.col("_n") / limit).alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
    dealt = many.join(F.broadcast(hot), key, "left").withColumn("_part", F.pmod(F.xxhash64(*[c for c in many.columns if c != key] or [key]), parts))
    repeated = one.join(F.broadcast(hot), key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    return dealt.drop("_parts").join(repeated.drop("_parts"), [key, "_part"], how).drop("_part")
