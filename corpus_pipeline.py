"""Corpus pipeline: toxic texts out, one of each group of near-duplicates, no benchmark passages, secrets masked, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. ``run`` writes each stage's rows
as Parquet to the cluster's shared folder and reads them back, so that a stage starts from files and a lost executor
costs tasks of one stage. All stages but the last return the columns of ``documents``.

NULL texts pass every filter and come out with no tokens. A masked text's ``n_chars`` is its new length; texts
without a secret keep theirs. Further columns, whatever their names, travel through the first four stages as one
struct that no operator looks into, and come out as they were; the last stage drops them. Rows with a NULL id are never
trained on and otherwise treated like all others; repeated rows are copies, of which the second stage keeps one. An
empty table gives an empty table at every stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm import bpe, decontaminate, ngram_join, secret_scan, toxicity
from lodgeframe.llm.queries import reach_package, vocabulary_path
from lodgeframe.queries.base import scratch, table

VOCABULARY = "byte_bpe_50k.json"
# The columns of documents, and the one that holds all others while an operator runs.
OWN = ("doc_id", "text", "lang", "source", "n_chars")
CARRIED = "carried_columns"


def keeping_columns(stage):
    """A stage on documents alone: their other columns are packed away before it and put back behind it, in place."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in OWN]
        if not others:
            return stage(spark, docs, sf_dir)
        quoted = {c: "`" + c.replace("`", "``") + "`" for c in docs.columns}
        packed = F.struct(*[F.col(quoted[c]).alias(f"c{i}") for i, c in enumerate(others)]).alias(CARRIED)
        kept = stage(spark, docs.select(*[c for c in docs.columns if c in OWN], packed), sf_dir)
        places = {c: f"{CARRIED}.c{i}" for i, c in enumerate(others)}
        return kept.select(*[F.col(places.get(c, quoted[c])).alias(c) for c in docs.columns])

    return run


@keeping_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, score="_score", predicted="_toxic").where("_toxic = 0").select(*docs.columns)


@keeping_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word Jaccard similarity 0.8 or more hold together."""
    return ngram_join.keep_one(docs).select(*docs.columns)


@keeping_columns
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, whole or with up to a tenth of its characters edited."""
    found = decontaminate.with_matches(docs, table(spark, sf_dir, "benchmark"), matches="_matches")
    return found.where(F.size("_matches") == 0).select(*docs.columns)


@keeping_columns
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    found = secret_scan.find_secrets(docs, secrets="_secrets")
    masked = F.size("_secrets") > 0
    text = secret_scan.redact(F.col("text"), F.col("_secrets"))
    return found.withColumn("n_chars", F.when(masked, F.length(text).cast("bigint")).otherwise(F.col("n_chars"))).withColumn("text", text).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of every document."""
    tokens = bpe.encode(docs.select("doc_id", "text"), vocabulary_path(VOCABULARY))
    return tokens.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("tokens", tokenize),
]

# A regression over fuzzy hits and merge rounds have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    reach_package(spark)
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
