"""The pipeline stage by stage, and the queries' contracts on the small tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodgeframe.llm import decontaminate, ngram_join, secret_scan, toxicity
from lodgeframe.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_stages_do_what_they_decide(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en", None, None), (-2, "", None, "s", 0), (-3, "api_key = abcdef123", "en", "s", 19)], docs.schema)
    docs = docs.unionByName(odd).withColumn("score", F.lit(7)).withColumn("matches", F.lit("m"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"] for r in docs.collect()}
        if name != "tokens":
            assert docs.columns == before.columns and docs.where("score = 7 AND matches = 'm'").count() == docs.count()
    assert {-1, -2, -3} <= kept["tokens"] and len(kept["tokens"]) == docs.count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert sum(labels.get(i) == 1 for i in kept["toxicity"]) <= 4 and sum(labels.get(i) == 0 for i in kept["toxicity"]) >= 70
    single = spark.read.parquet(f"{tmp_path}/near_duplicates")
    assert ngram_join.join_documents(single).where("class_id <> doc_id").count() == 0
    clean = spark.read.parquet(f"{tmp_path}/decontamination")
    assert decontaminate.find_matches(clean, spark.read.parquet(f"{SMALL}/benchmark.parquet")).count() == 0
    masked = spark.read.parquet(f"{tmp_path}/secrets")
    assert secret_scan.find_secrets(masked).where(F.size("secrets") > 0).count() == 0
    assert masked.where("doc_id = -3").first()["text"] == "<secret>" and masked.where("doc_id = -3").first()["n_chars"] == 8
    assert kept["secrets"] == kept["decontamination"]


CLASHING = ["_score", "_toxic", "_secrets", "_matches", "_asked", "_matches_0", "node", "a`b", "carried_columns"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_clashing_columns_and_odd_rows(spark, name, stage):
    """Columns named like the operators' own keep their values; NULL ids, repeated rows and an empty table have their results."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, f"text without an id {i}", "en", "s", 20) for i in range(2)] + [(-9, "twice", "en", "s", 5)] * 2, docs.schema)
    docs = docs.unionByName(odd)
    for c in CLASHING:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c}:"), "text"))
    plain = docs.select(*[f"`{c}`" for c in corpus_pipeline.OWN])
    out = stage(spark, docs, SMALL).cache()
    if name == "tokens":
        assert out.columns == ["doc_id", "ids", "n_tokens"] and out.count() == docs.count()
        return
    assert out.columns == docs.columns
    if name != "secrets":
        for c in CLASHING:
            assert out.where(~F.col("`" + c.replace("`", "``") + "`").eqNullSafe(F.concat(F.lit(f"{c}:"), "text"))).count() == 0
    else:
        assert out.where(~F.col("_secrets").startswith("_secrets:")).count() == 0 and out.count() == docs.count()
    rows = sorted(map(str, out.select(*[f"`{c}`" for c in corpus_pipeline.OWN]).collect()))
    assert rows == sorted(map(str, stage(spark, plain, SMALL).collect()))
    assert out.where("doc_id = -9").count() == (1 if name == "near_duplicates" else 2)
    assert out.where("doc_id IS NULL").count() == 2
    assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "ids", "n_tokens"] and out.where("size(ids) <> n_tokens").count() == 0 and out.count() > 100


def test_held_out_rows_are_the_stated_fold(spark):
    import zlib

    rows = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted(str([row[names.index(c)] for c in columns]) for row in cursor.fetchall())
    assert sorted(str([r[c] for c in columns]) for r in df.collect()) == theirs


@pytest.mark.parametrize("name", ["op1_url_filter", "op5_secret_scan"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
