"""One query per operator over its whole table, with production parameters, and SQL where it can express the rows."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm import bpe, cap_filters, decontaminate, fingerprints, hard_negatives, license_scan, ngram_join, oracles, prefix_trie, secret_scan, sharding, token_files, toxicity, url_filter
from lodgeframe.llm.hot import join_hot
from lodgeframe.queries.base import scratch, table
from lodgeframe.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def vocabulary_path(name: str) -> str:
    """A file of the installed vocabularies, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def reach_package(spark: SparkSession) -> None:
    """Let Python workers that start in another folder import this package; a cluster ships it with the job."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_url_filter")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


@query("op5_secret_scan", oracles.secrets_sql())
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s.kind.isin(*[r.kind for r in secret_scan.BASE]))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in secret_scan.BASE],
        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("secrets")).alias("spans"),
    )


@query("op2_bpe_codec")
def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = vocabulary_path("byte_bpe_50k.json")
    tokens = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text"), vocabulary)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/tokens"
    token_files.write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), path, vocabulary_path("word_bpe_49k.json"))
    return token_files.read_documents(spark, path)


@query("op4_two_pass_shuffle")
def op4_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shuffle_into_shards(docs, f"{scratch(spark)}/shards", 16)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op8_ngram_join", oracles.NGRAMS)
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


@query("op7_cap_filters", oracles.VECTORS)
def op7_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op6_license_scan")
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, sf_dir, "documents"))


def shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of the conversations rebuilt for op13: first turns of a conversation's group, then its own.

    Remainders of negative ids take the sign of the id, as in SQL. A group's first turns are at most eight rows, given to
    at most nine conversations.
    """
    own_part = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(9))
    group = F.col("conv") - F.col("conv") % 5
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"))
    known = sizes.select("conv", own_part.alias("h"), group.alias("group"))
    held = sizes.select(F.col("conv").alias("group"), F.least("n", F.lit(8)).alias("held"))
    opened = cut_lineage(known.join(held, "group", "left").withColumn("opening", F.coalesce(F.least("h", "held"), F.lit(0))))
    first = turns.where((F.col("position") <= 8) & (F.col("conv") % 5 == 0)).withColumnRenamed("conv", "group")
    shared = opened.where("opening > 0").join(first, "group").where(F.col("position") <= F.col("opening"))
    later = turns.where(F.col("position") > own_part)
    later = join_hot(later, opened.select("conv", "h", "opening"), "conv").withColumn("position", F.col("position") - F.col("h") + F.col("opening"))
    columns = ["conv", "position", "turn_name", "bytes"]
    return shared.select(*columns).unionByName(later.select(*columns)), opened.select("conv")


@query("op13_prefix_trie", oracles.PREFIX_TRIE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut_lineage(prefix_trie.numbered(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(*shared_openings(turns))


@query("op11_hard_negatives", oracles.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


@query("op12_fingerprints", oracles.fingerprints_sql())
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    prints = fingerprints.with_fingerprints(
        rows.withColumn("edited", edited), {"text": "fingerprint", "edited": "edited_fingerprint", "next_text": "next_fingerprint"}
    )
    slim = prints.select(
        F.col("key").alias("doc_id"), n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "next_fingerprint",
    )
    pairs = {"edited_fingerprint": ("near_edited", "edited_at"), "next_fingerprint": ("near_next", "next_at")}
    return fingerprints.with_likeness(slim, "fingerprint", pairs).drop("next_fingerprint", "edited_at", "next_at")
