from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.operators.dedup import drop_ids, keep_ids, keep_last
from lodgeframe.operators.diff import diff_versions, diff_wide_versions
from lodgeframe.operators.merge import INSERT_DEFAULTS, LISTING_RULES, UPDATE_DEFAULTS, merge_counts, merge_keyed
from lodgeframe.sources.tables import evolve

NOW = datetime(2026, 7, 14, 5)
OLD = datetime(2026, 1, 1)


def listing(spark, rows):
    """Listing rows from dicts; columns not named are NULL."""
    names = sorted({k for r in rows for k in r} | {"feed_provider_id"})
    fields = [schemas.LISTING_SCHEMA[n] for n in names]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.T.StructType(fields))
    return evolve(df, schemas.LISTING_SCHEMA).select(*schemas.LISTING_COLUMNS)


def merged(spark, current, staged, broadcast_rows=1000):
    df = merge_keyed(
        listing(spark, current), listing(spark, staged).select(*schemas.STAGED_COLUMNS), "feed_provider_id",
        LISTING_RULES, F.lit(NOW), UPDATE_DEFAULTS, INSERT_DEFAULTS, broadcast_rows,
    )
    assert df.columns == schemas.LISTING_COLUMNS
    return {r["feed_provider_id"]: r.asDict() for r in df.collect()}


def test_rules_cover_every_column():
    assert set(LISTING_RULES) == set(schemas.LISTING_COLUMNS) - {"feed_provider_id"}


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_empty_values_do_not_replace_known_ones(spark, broadcast_rows):
    stored = dict(
        feed_provider_id="1", property_name="Old", city=None, star_rating=4, images=["a"], amenities=["b"], amenity_categories=["c"],
        policy='{"x": 1}', feature_summary='[{"name": "n"}]', raw_data="first", created_at=OLD, last_synced_at=OLD, source_created_at=OLD,
        number_of_review=None, currency="EUR", min_stay=None, is_published=True,
    )
    incoming = dict(
        feed_provider_id="1", property_name="", city="Paris", star_rating=None, images=[], amenities=None, amenity_categories=["d"],
        policy="{}", feature_summary="[]", raw_data="second", number_of_review=None, currency="", is_published=False,
    )
    row = merged(spark, [stored, dict(feed_provider_id="9", city="kept")], [incoming], broadcast_rows)
    r = row["1"]
    assert (r["property_name"], r["city"], r["star_rating"]) == ("Old", "Paris", 4)
    assert (r["images"], r["amenities"], r["amenity_categories"]) == (["a"], None, ["d"])
    assert (r["policy"], r["feature_summary"], r["raw_data"]) == ('{"x": 1}', '[{"name": "n"}]', "first")
    assert (r["number_of_review"], r["min_stay"], r["currency"], r["is_published"]) == (0, 1, "EUR", False)
    assert (r["created_at"], r["source_created_at"], r["last_synced_at"], r["source_updated_at"]) == (OLD, OLD, NOW, NOW)
    assert row["9"]["city"] == "kept" and row["9"]["last_synced_at"] is None


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_new_keys_are_inserted_with_defaults(spark, broadcast_rows):
    rows = merged(spark, [dict(feed_provider_id=None, city="a")], [dict(feed_provider_id="2", currency="", raw_data="r"), dict(feed_provider_id=None, city="b")], broadcast_rows)
    r = rows["2"]
    assert (r["number_of_review"], r["min_stay"], r["currency"], r["is_published"]) == (0, 1, "", True)
    assert {r["created_at"], r["source_created_at"], r["last_synced_at"], r["source_updated_at"]} == {NOW}
    assert r["raw_data"] == "r"


def test_null_keys_match_nothing(spark):
    for limit in (1000, 0):
        df = merge_keyed(
            listing(spark, [dict(feed_provider_id=None, city="a")]), listing(spark, [dict(feed_provider_id=None, city="b")]),
            "feed_provider_id", LISTING_RULES, F.lit(NOW), broadcast_rows=limit,
        )
        assert sorted(r["city"] for r in df.collect()) == ["a", "b"]


def test_counts(spark):
    counts = merge_counts(listing(spark, [dict(feed_provider_id="1")]), listing(spark, [dict(feed_provider_id=x) for x in "123"]), "feed_provider_id")
    assert tuple(counts.first()) == (2, 1)


def test_last_wins_and_id_filters(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y"), (None, 1, "z")], "k string, o int, v string")
    assert sorted((r["k"] or "", r["v"]) for r in keep_last(df, ["k"], ["o"]).collect()) == [("", "z"), ("a", None), ("b", "y")]
    ids = spark.createDataFrame([("a",)], "id string")
    assert {r["k"] for r in keep_ids(df, ids, "k").collect()} == {"a"}
    assert {r["k"] for r in drop_ids(df, ids, "k").collect()} == {"b", None}


def test_diff(spark):
    old = listing(spark, [dict(feed_provider_id=str(i), city="c", star_rating=3, images=["a"], language="en") for i in range(5)])
    new = listing(
        spark,
        [
            dict(feed_provider_id="0", city="c", star_rating=3, images=["a"], language="de"),
            dict(feed_provider_id="1", city="d", star_rating=3, images=["a"], property_name="n"),
            dict(feed_provider_id="2", city=None, star_rating=4, images=["a", "b"]),
            dict(feed_provider_id="new", city="c"),
            dict(feed_provider_id=None, city="c"),
        ],
    )
    rows = {r["feed_provider_id"]: r["changed_fields"] for r in diff_versions(old, new).collect()}
    assert rows == {"1": ["property_name", "city"], "2": ["city", "star_rating", "images"]}
    wide = diff_wide_versions(old, new)
    assert {r["feed_provider_id"]: r["changed_fields"] for r in wide.collect()} == rows
    everything = {r["feed_provider_id"]: r["changed_fields"] for r in diff_versions(old, new, include_unchanged=True).collect()}
    assert everything == {**rows, "0": []}


def test_wide_diff_sees_moved_nulls_and_empty_values(spark):
    """A value that moves from one column to another, NULL against empty, repeated keys: as the plain comparison."""
    old = listing(spark, [dict(feed_provider_id="1", city="a"), dict(feed_provider_id="2", images=[]), dict(feed_provider_id="3", city="x"), dict(feed_provider_id="3", city="y")])
    new = listing(spark, [dict(feed_provider_id="1", country="a"), dict(feed_provider_id="2", images=None), dict(feed_provider_id="3", city="x"), dict(feed_provider_id="4")])
    order = lambda df: sorted((r["feed_provider_id"], r["changed_fields"]) for r in df.collect())
    assert order(diff_wide_versions(old, new)) == order(diff_versions(old, new)) != []
    assert diff_wide_versions(old, old.limit(0)).count() == 0
