import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.operators.cleaning import parse_records
from lodgeframe.plans.daily_sync import sync_day
from lodgeframe.sources import feeds, lookups
from lodgeframe.sources.partner import partner_rows
from lodgeframe.sources.tables import VersionedTable, evolve

DAY = "20251103"


def listing(number, **changes):
    """A listing record whose values follow from its number; ``changes`` replace whole keys."""
    record = {
        "id": number,
        "unlisted": [{"n": number}],
        "url": {"web": f"https://stays.test/{number}"},
        "partner_location_id": f"P{number % 100}",
        "name": {"en-us": f"  Quay Loft {number} "},
        "accommodation_type": 31,
        "accommodation_status": "open",
        "location": {
            "city": 88,
            "country": "pt",
            "coordinates": {"longitude": f"-{number % 9}.25", "latitude": 38.5},
            "address": {"en-us": f"Pier {number % 10}"},
        },
        "rooms": [
            {"maximum_occupancy": {"children": 2, "total_guests": 5}, "number_of_rooms": {"bathrooms": 1.0, "bedrooms": 2}},
            {"number_of_rooms": {"bedrooms": 9}},
        ],
        "rating": {"number_of_reviews": 12, "review_score": 7, "stars": 4},
        "photos": [{"main_photo": n == 1, "url": {"standard": f"https://img.test/{number}/{n}.png"}} for n in range(3)],
        "facilities": [{"id": n} for n in (11, 900, 12, 13, 11)],
        "policies": {"minimum_checkin_age": 16, "pets": {"allowed": "yes"}},
        "description": {"important_information": {"en-us": "Quiet after ten. "}, "text": {"en-us": "A <i>bright</i> loft<br>by the water"}},
        "work_friendly_home": True,
        "long_stay_friendly_home": False,
        "min_stay": 3,
    }
    return {**record, **changes}


RECORD = listing(4417)


def put(root, relative, content):
    path = root / relative
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")


def named(text, **more):
    return {"name": {"en-us": text}, **more}


@pytest.fixture
def feed_root(tmp_path):
    facilities = {"11": named("Sauna", facility_type="1"), "12": named("Desk", facility_type=2), "13": named("Lift"), "14": {"facility_type": 1}}
    put(tmp_path, "static/constants.json", {
        "facility_types": {"1": named("Wellness"), "2": named("Work")},
        "accommodation_facilities": facilities,
        "accommodation_types": {"31": named("Loft"), "32": {"name": {"pt": "Quinta"}}},
    })
    groups = [{"group_name": "City", "property_type_name": "Loft"}, 17, {"group_name": "Lost"}, {"property_type_name": "Tent"}]
    put(tmp_path, "static/property_type_categories.json", {"property_type_mapping": {"mapped": groups}})
    put(tmp_path, "static/location_mapping/countries.json", {"pt": "Portugal", "NO": "Norway"})
    put(tmp_path, "static/location_mapping/pt/city.json", [{"city": "Nowhere"}, {"city": "Évora", "city_code": 88}])
    put(tmp_path, f"changelog/{DAY}/run_changed_20251030.json", {"changed": ["21", 22, 24, 4417]})
    put(tmp_path, f"changelog/{DAY}/run_changed_20251101.json", [666])
    put(tmp_path, f"changelog/{DAY}/run_opened_20251103.json", [23, 4417])
    base = f"accommodation_details/{DAY}"
    put(tmp_path, f"{base}/changed/p1.json", [{"id": 21, **named("Hut one")}, {"id": 22, "accommodation_status": "closed_temporarily"}, {"id": 500}, 8])
    put(tmp_path, f"{base}/changed/p2.json", "[{]")
    put(tmp_path, f"{base}/changed/p3.json", {"rental_property": RECORD})
    put(tmp_path, f"{base}/opened/q1.json", [{"id": 23}])
    put(tmp_path, f"{base}/opened/q2.json", {"id": 21, **named("Hut one, renewed"), "rating": {"stars": "many"}})
    offers = [
        {"id": 4417, "currency": {"booker": "NOK"}, "price": {"base": {"booker_currency": 70}}},
        {"id": 4417, "currency": {"booker": "EUR"}, "price": {"base": {"booker_currency": 88.5}},
         "products": [{"policies": {"cancellation": {"type": "free_cancellation"}}}, {}]},
        {"price": {"base": {"booker_currency": 3}}},
    ]
    put(tmp_path, f"search/{DAY}/changed/offers.json", offers)
    return tmp_path


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_changelog_reads_first_file_of_either_shape(spark, feed_root):
    root = str(feed_root)
    assert ids(feeds.changelog_ids(spark, root, DAY, "changed")) == ["21", "22", "24", "4417"]
    assert ids(feeds.changelog_ids(spark, root, DAY, "opened")) == ["23", "4417"]
    assert ids(feeds.changelog_ids(spark, root, DAY, "closed")) == []
    assert ids(feeds.changelog_ids(spark, root, "19990101")) == []
    assert ids(feeds.relevant_ids(spark, root, DAY)) == ["21", "22", "23", "24", "4417"]


def test_records_of_all_three_file_shapes(spark, feed_root):
    rows = feeds.feed_records(spark, str(feed_root), "accommodation_details", DAY, "opened", "id string, name map<string,string>").collect()
    assert sorted((r["id"], (r["name"] or {}).get("en-us")) for r in rows) == [("21", "Hut one, renewed"), ("23", None)]
    assert feeds.feed_records(spark, str(feed_root), "search", "19990101", "changed", "id string").count() == 0
    assert feeds.raw_listings(spark, str(feed_root), "19990101").count() == 0


def test_raw_records_keep_everything(spark, feed_root):
    rows = feeds.raw_listings(spark, str(feed_root), DAY).orderBy("_bucket", "_file", "_pos").collect()
    texts = [None if r["raw_data"] is None else json.loads(r["raw_data"]) for r in rows]
    ids_or_text = [t["id"] if isinstance(t, dict) else t for t in texts]
    assert ids_or_text == [21, 22, 500, 8, None, 4417, 23, 21]
    assert texts[5] == RECORD and rows[4]["_file"].endswith("/p2.json")


def test_a_file_above_the_size_of_a_variant_is_read_whole(spark, tmp_path):
    path = tmp_path / f"accommodation_details/{DAY}/changed/large.json"
    path.parent.mkdir(parents=True)
    with path.open("w") as f:  # 140 MB
        f.write("[" + ",".join(json.dumps({"id": n, "padding": "x" * 10_000}) for n in range(14_000)) + "]")
    rows = feeds.raw_listings(spark, str(tmp_path), DAY)
    got = rows.agg(F.count("*"), F.count("raw_data"), F.countDistinct(F.get_json_object("raw_data", "$.id"))).first()
    assert tuple(got) == (14_000, 14_000, 14_000)


def test_price_map_takes_the_last_record(spark, feed_root):
    rows = feeds.search_prices(spark, str(feed_root), DAY).collect()
    assert [tuple(r) for r in rows] == [("4417", "EUR", 88.5, True)]


def test_lookups(spark, feed_root):
    found = lookups.load_lookups(spark, str(feed_root))
    assert [tuple(r) for r in found.types.collect()] == [("31", "Loft")]
    assert sorted(tuple(r) for r in found.categories.collect()) == [("Loft", "City"), ("Tent", "")]
    assert sorted(tuple(r) for r in found.countries.collect()) == [("no", "Norway"), ("pt", "Portugal")]
    assert [tuple(r) for r in found.cities.collect()] == [("pt", "88", "Évora")]
    assert sorted(tuple(r) for r in found.facilities.collect()) == [
        ("11", "Sauna", "Wellness"), ("12", "Desk", "Work"), ("13", "Lift", None), ("14", None, "Wellness")]
    assert lookups.load_lookups(spark, str(feed_root / "nowhere")).types.count() == 0


def test_changed_lookup_files_are_seen_without_release(spark, feed_root):
    lookups.load_lookups(spark, str(feed_root)).countries.collect()
    put(feed_root, "static/location_mapping/countries.json", {"pt": "Portugal (new)"})
    again = lookups.load_lookups(spark, str(feed_root))
    assert [tuple(r) for r in again.countries.collect()] == [("pt", "Portugal (new)")]
    again.release()


def test_location_names(spark, feed_root):
    assert [tuple(r) for r in lookups.location_names(spark, str(feed_root), "PT", "city").collect()] == [("88", "Évora")]
    assert lookups.location_names(spark, str(feed_root), "xx", "city").count() == 0


def test_sync_end_to_end(spark, feed_root):
    table = VersionedTable(spark, str(feed_root / "table"))
    rejects, events = str(feed_root / "rejects"), str(feed_root / "events")
    first = sync_day(spark, str(feed_root), table, DAY, datetime(2025, 11, 3, 1, tzinfo=timezone.utc), events, rejects)
    assert (first.created, first.updated, first.errors, first.skipped, first.version) == (4, 0, 2, 1, 1)
    kept = spark.read.json(f"{rejects}/date={DAY}").collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["reason"], r["raw_data"]) for r in kept) == [
        ("p1.json", "record is not an object", "8"), ("p2.json", "file is not valid JSON", None)]
    rows = {r["feed_provider_id"]: r for r in table.read().collect()}
    assert set(rows) == {"21", "22", "23", "4417"}
    assert table.read().columns == schemas.LISTING_COLUMNS
    r = rows["4417"].asDict()
    expected = {
        "external_id": "BC-4417", "feed": 11, "property_name": "Quay Loft 4417", "property_slug": "quay-loft-4417",
        "property_type": "Loft", "property_type_category": "City", "city": "Évora", "country": "Portugal", "country_code": "pt",
        "latlon": "SRID=4326;POINT (-7.25 38.5)", "language": "en-us", "star_rating": 4, "number_of_review": 12, "bedroom_count": 2,
        "bathroom_count": 1, "occupancy": 5, "max_occupancy": 5, "currency": "EUR", "min_stay": 3,
        "feature_image": "https://img.test/4417/1.png", "family_friendly": True, "group_friendly": False,
        "amenities": ["Sauna", "Desk", "Lift", "Sauna"], "amenity_categories": ["Wellness", "Work"], "other_policy": "Quiet after ten.",
        "is_published": True, "partner_location_id": "P17", "location_display": "Pier 7", "feed_provider_url": "https://stays.test/4417",
    }
    assert {k: r[k] for k in expected} == expected
    assert sorted(r["images"]) == [f"https://img.test/4417/{n}.png" for n in range(3)]
    assert (float(r["review_score"]), float(r["review_score_general"]), float(r["price"])) == (7.0, 3.5, 88.5)
    policy = json.loads(r["policy"])
    assert (policy["pets_allowed"], policy["adults_only_checkin"], policy["minimum_checkin_age"], policy["free_cancellation"]) == (True, False, 16, True)
    assert json.loads(r["property_flags"]) == {
        "work_friendly_home": True, "long_stay_friendly_home": False, "eco_friendly_home": False, "adult_only": False}
    assert json.loads(r["feature_summary"]) == [
        {"name": "Wellness", "description": "Sauna\nSauna"}, {"name": "Work", "description": "Desk"}]
    assert json.loads(r["raw_data"]) == RECORD
    hut = rows["21"]
    assert (hut["property_name"], hut["star_rating"], hut["is_published"], hut["currency"], hut["price"]) == ("Hut one, renewed", None, False, "USD", None)
    assert json.loads(hut["policy"])["minimum_checkin_age"] is None
    told = spark.read.schema(schemas.CHANGE_EVENT_DDL).json(events).collect()
    assert sorted(i for e in told for i in e["feed_provider_ids"]) == ["21", "22", "23", "4417"]

    # The same day again changes nothing but the two sync times, and leaves nothing cached.
    second = sync_day(spark, str(feed_root), table, DAY, datetime(2025, 11, 3, 2, tzinfo=timezone.utc))
    assert (second.created, second.updated, second.version) == (0, 4, 2)
    stamps = ("source_updated_at", "last_synced_at")
    again = {r["feed_provider_id"]: r for r in table.read().collect()}
    for key, row in rows.items():
        old, new = row.asDict(), again[key].asDict()
        assert all(old.pop(s) != new.pop(s) for s in stamps)
        assert old == new
    assert table.versions() == [1, 2]
    assert not lookups.countries(lookups.static_map(spark, str(feed_root), "static/location_mapping/countries.json")).is_cached


def test_day_without_changelog_writes_nothing(spark, feed_root):
    table = VersionedTable(spark, str(feed_root / "empty"))
    result = sync_day(spark, str(feed_root), table, "19990101", datetime(2025, 11, 3), str(feed_root / "none"), str(feed_root / "no-rejects"))
    assert (result.created, result.updated, result.version) == (0, 0, None)
    assert table.versions() == [] and not (feed_root / "none").exists() and not (feed_root / "no-rejects").exists()


@pytest.mark.parametrize("wrapper", [None, "properties", "data"])
def test_partner_file_shapes(spark, tmp_path, wrapper):
    rows = [{"id": "v1", "latlon": {"lat": 1, "lon": 2}, "bedroom_count": 2}, {"external_id": "v2", "latlon": "POINT (2 1)"}]
    put(tmp_path, "p.json", rows if wrapper is None else {wrapper: rows})
    got = partner_rows(spark, str(tmp_path / "p.json")).orderBy(F.coalesce("external_id", "id")).collect()
    assert [(r["external_id"], r["id"]) for r in got] == [(None, "v1"), ("v2", None)]
    assert json.loads(got[0]["latlon"]) == {"lat": 1, "lon": 2} and got[1]["latlon"] == "POINT (2 1)"


def test_versions_and_added_columns(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path))
    narrow = spark.createDataFrame([("1", "a")], "feed_provider_id string, property_name string")
    assert table.write(narrow) == 1
    assert set(table.read().columns) == set(schemas.LISTING_COLUMNS)
    (tmp_path / "version=2-dead").mkdir()  # unfinished
    assert table.versions() == [1]
    with pytest.raises(ValueError):
        table.read(2)
    table.log.commit(2, "taken by another sync")
    with pytest.raises(FileExistsError):
        table.log.commit(2, "version=2-late")
    assert evolve(narrow, schemas.LISTING_SCHEMA).schema["price"].dataType.simpleString() == "decimal(10,2)"


def test_keys_that_differ_in_case(spark, tmp_path):
    """In one record, between the records of a file, between files, and beside a wrapped record."""
    folder = tmp_path / "accommodation_details/20260714/changed"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('[{"id": 1, "Extra": "a", "extra": "b"}, {"id": 2, "ID": 7}]')
    (folder / "b.json").write_text('{"id": 3, "EXTRA": [1], "a`b.c": 1, "_corrupt_record": "kept"}')
    (folder / "c.json").write_text('{"rental_property": {"id": 4, "Id": 5}}')
    (folder / "d.json").write_text("no json")
    rows = feeds.raw_listings(spark, str(tmp_path), "20260714").orderBy("_file", "_pos").collect()
    assert [None if r["raw_data"] is None else json.loads(r["raw_data"]) for r in rows] == [
        {"id": 1, "Extra": "a", "extra": "b"}, {"id": 2, "ID": 7}, {"id": 3, "EXTRA": [1], "a`b.c": 1, "_corrupt_record": "kept"}, {"id": 4, "Id": 5}, None,
    ]
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
    parsed = parse_records(feeds.raw_listings(spark, str(tmp_path), "20260714")).where("r.id IS NOT NULL").select("r.id")
    assert sorted(int(r["id"]) for r in parsed.collect()) == [1, 2, 3, 4]


CHANGELOGS = [
    '["a", "b", 3, 4.50, null, true, "\\"q\\"", "é\\u00e9"]', '{"changed": ["a",\n "b"]}\n', '{ "changed" : [ ] }', "[]", '["a"]', "[1]", '["a, b", "c"]',
    '{"changed": ["a"], "opened": ["b"]}', '{"date": "x", "changed": ["a", "b"]}', '[["a"], "b"]', '[{"id": 1}]', "no json", "", '["a", "b"', '["a",]', '{"opened": ["a"]}',
    '["a", "]", "[", "{", ":"]', '{"changed": ["a"]', '["a"] ["b"]', '["a" "b"]', '[nope]', '"a"', '[" a ", ""]',
]


def test_changelog_in_pieces_equals_whole(spark, tmp_path):
    for i, text in enumerate(CHANGELOGS):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        whole = sorted(str(r["id"]) for r in feeds._whole_ids(spark, str(path), "changed").collect())
        split = feeds._split_ids(spark, str(path), "changed")
        assert split is None or sorted(str(r["id"]) for r in split.collect()) == whole, text
        assert (split is not None) or i not in (0, 1, 2, 3, 4, 5)


def test_a_long_changelog_is_read_by_several_tasks(spark, tmp_path):
    folder = tmp_path / "changelog/20260714"
    folder.mkdir(parents=True)
    (folder / "x_changed_1.json").write_text(json.dumps({"changed": [f"id-{i}" for i in range(200_000)]}))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500_000)
    try:
        ids = feeds.changelog_ids(spark, str(tmp_path), "20260714")
        assert ids.rdd.getNumPartitions() > 4
        assert ids.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first() == (200_000, 200_000, "id-0", "id-99999")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def file_bytes(spark):
    """Bytes that this process has read from files so far."""
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


@pytest.mark.parametrize("source", ["partner", "search"])
def test_numbers_and_objects_read_as_text_do_not_read_the_file_again(spark, tmp_path, source):
    """The reader went back to the file for the characters of every number or object that was asked for as text."""
    price = {"base": {"booker_currency": 12.5}}
    rows = [{"id": n, "latlon": {"lat": 2.0, "lon": 1e-7}, "bedroom_count": 2.0, "price": price} for n in range(3000)]
    path = put(tmp_path, f"search/{DAY}/changed/p.json", rows) or tmp_path / f"search/{DAY}/changed/p.json"
    before = file_bytes(spark)
    if source == "partner":
        got = {r["id"]: (r["bedroom_count"], json.loads(r["latlon"])) for r in partner_rows(spark, str(path)).collect()}
        assert got == {str(n): ("2.0", {"lat": 2.0, "lon": 1e-7}) for n in range(3000)}
    else:
        got = {r["id"]: r["price"] for r in feeds.search_prices(spark, str(tmp_path), DAY).collect()}
        assert got == {str(n): 12.5 for n in range(3000)}
    assert file_bytes(spark) - before < 8 * path.stat().st_size


def test_many_feed_files_are_not_listed_by_a_task_each(spark, tmp_path):
    for n in range(60):
        put(tmp_path, f"search/{DAY}/changed/p{n:02d}.json", [{"id": n, "price": {"base": {"booker_currency": "1.5"}}}])
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    sc.setJobGroup("listing", "files of one feed")
    try:
        assert feeds.search_prices(spark, str(tmp_path), DAY).count() == 60
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) < 60
