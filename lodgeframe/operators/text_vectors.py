"""Vectors for distinct texts: from Spark ML, or from a model the caller brings."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.terms import words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 384  # fixed value


def distinct_texts(*columns: DataFrame) -> DataFrame:
    """Distinct non-empty texts of one-column DataFrames as ``(text)``."""
    parts = [c.toDF("text") for c in columns]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where(F.col("text") != "").dropDuplicates(["text"])


def tfidf_vectors(texts: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``(text, vector)``: hashed word counts, weighted by rarity over all texts, at unit length."""
    counted = HashingTF(inputCol="words", outputCol="tf", numFeatures=dimensions).transform(
        texts.select("text", words(F.col("text")).alias("words"))
    )
    weighted = IDF(inputCol="tf", outputCol="tfidf").fit(counted).transform(counted)
    unit = Normalizer(inputCol="tfidf", outputCol="unit").transform(weighted)
    return unit.select("text", vector_to_array("unit", "float32").alias("vector"))


def model_vectors(texts: DataFrame, load: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """``(text, vector)`` from a model. ``load`` runs once per task and returns a batch encoder."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load()
        for batch in batches:
            if not batch.empty:
                yield pd.DataFrame({"text": batch["text"], "vector": list(encoder(batch["text"].tolist()))})

    return texts.select("text").mapInPandas(encode, "text string, vector array<float>")
