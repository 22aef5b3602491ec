"""Best photos of a listing, from a table of image scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The labels photos are matched against, and how many photos are kept.
ROOM_LABELS = ["bedroom", "balcony", "bathroom", "swimming pool", "house"]
TOP_IMAGES = 4


def best_label(label_scores: Column, labels: list[str] = ROOM_LABELS) -> Column:
    """``(label, confidence)`` of the highest score; ties go to the label listed first."""
    options = F.array(*[F.struct((-label_scores[x]).alias("neg"), F.lit(i).alias("i"), F.lit(x).alias("label")) for i, x in enumerate(labels)])
    known = F.filter(options, lambda o: o["neg"].isNotNull())
    best = F.array_min(known)
    return F.struct(best["label"].alias("label"), F.round(-best["neg"], 4).alias("confidence"))


def image_analysis(scores: DataFrame, labels: list[str] = ROOM_LABELS) -> DataFrame:
    """One row per scored image: score from 0 to 10, best label and its confidence.

    ``scores`` carries ``listing_id, url, aesthetic, label_scores``; images without a score are skipped.
    """
    top = best_label(F.col("label_scores"), labels)
    return scores.where(F.col("aesthetic").isNotNull()).select(
        "listing_id",
        "url",
        F.round(F.col("aesthetic") * 10, 2).alias("aesthetic_score"),
        top["label"].alias("label"),
        top["confidence"].alias("label_confidence"),
    )


def best_images(analysis: DataFrame, top: int = TOP_IMAGES) -> DataFrame:
    """``(listing_id, rank, url, aesthetic_score, label, label_confidence)``, the best ``top`` per listing."""
    w = Window.partitionBy("listing_id").orderBy(F.desc("aesthetic_score"), "url")
    return analysis.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def ranked_images(best: DataFrame) -> DataFrame:
    """``(listing_id, ranked_image, ranked_images)``; lists are as short as ``best_images`` made them."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "url"))), lambda i: i["url"])
    lists = best.groupBy("listing_id").agg(ordered.alias("urls"))
    return lists.select(
        "listing_id",
        F.col("urls")[0].alias("ranked_image"),
        F.struct(F.size("urls").alias("Count"), F.col("urls").alias("Images")).alias("ranked_images"),
    )
