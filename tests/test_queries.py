"""A few registered queries against their SQL; tools/check_oracles.py compares all of them."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_points

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    v = float(v) if isinstance(v, Decimal) else v
    return (None if math.isnan(v) else round(v, 6) + 0.0) if isinstance(v, float) else v


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["snapshot_diff", "merge_upsert", "feature_summary", "nearest_n", "similar_top_k", "sitemap_files", "duplicate_pairs"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = entry_points.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    cursor = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == theirs and theirs


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["nearest_n", "duplicate_pairs", "similar_top_k", "merge_upsert_shuffled", "nearby_union"])
def test_plans_hold_no_all_pairs_join(spark, name):
    plan = entry_points.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_listings_of_one_small_file_are_derived_by_many_tasks(spark, tmp_path):
    """A file of one split was derived, written and read again by one task."""
    from lodgeframe.queries.base import listing_rows

    spark.range(6000).selectExpr("id c_custkey", "concat('Customer ', id) c_name", "id % 3 c_nationkey", "'X' c_mktsegment", "1.5d c_acctbal").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3).selectExpr("id n_nationkey", "concat('N', id) n_name", "0L n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1).selectExpr("id r_regionkey", "'R' r_name").write.parquet(f"{tmp_path}/region.parquet")
    listings = listing_rows(spark, str(tmp_path))
    assert len(listings.inputFiles()) >= 4 and listings.count() == 6000
    assert listings.select("external_id").distinct().count() == 6000


def test_stream_replay_writes_the_listing_table_once(spark, tmp_path, monkeypatch):
    """The table was derived and written anew for its schema and for every batch of every run."""
    from lodgeframe.sources.tables import VersionedTable

    spark.range(40).selectExpr("id c_custkey", "concat('Customer ', id) c_name", "id % 3 c_nationkey", "'X' c_mktsegment", "1.5d c_acctbal").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3).selectExpr("id n_nationkey", "concat('N', id) n_name", "0L n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1).selectExpr("id r_regionkey", "'R' r_name").write.parquet(f"{tmp_path}/region.parquet")
    events = spark.range(60).selectExpr("timestamp'2024-01-02' ts", "if(id % 9 = 0, null, id % 30) user_id", "'view' event_type")
    events.write.parquet(f"{tmp_path}/events.parquet")
    written, write = [], VersionedTable.write
    monkeypatch.setattr(VersionedTable, "write", lambda self, df: written.append(1) or write(self, df))
    ids = sorted(r["id"] for r in entry_points.queries()["stream_replay"](spark, str(tmp_path)).collect())
    assert len(written) == 1
    assert ids == sorted(f"BC-{k}" for k in {n % 30 for n in range(60) if n % 9})
