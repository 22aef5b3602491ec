import gzip
import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodgeframe import schemas
from lodgeframe.operators import documents as docs
from lodgeframe.operators.sitemap import FOOTER, HEADER, Site, assign_files, nearby_sitemap_rows, url_blocks
from lodgeframe.plans.nearby import nearby_listings, nearby_place, similar_listings
from lodgeframe.plans.sitemaps import listing_sitemap, nearby_sitemap
from lodgeframe.sinks.exports import export_history, export_json, export_points, write_partitions
from lodgeframe.sinks.keyed_store import KeyedStore
from lodgeframe.sinks.sitemaps import write_root_index, write_sitemaps
from lodgeframe.sources.tables import evolve, exported_documents
from lodgeframe.streaming.change_events import run_change_stream

ROW = dict(
    external_id="BC-1812", feed=11, feed_provider_id="1812", feed_provider_url="https://www.example.com/x", property_name="Casa Lumen",
    property_slug="casa-lumen", property_type="Country House", city="Al Kut", country="Iraq", country_code="us",
    location_display="Old Harbour 4, Al Kut", partner_location_id="L-77", latlon="SRID=4326;POINT (45.8185 32.5128)", language="en-us",
    star_rating=3, review_score_general=Decimal("8.50"), number_of_review=0, bedroom_count=4, bathroom_count=4, occupancy=12,
    price=Decimal("199.99"), min_stay=1, feature_image="f.jpg", images=["1.jpg", "2.jpg"], family_friendly=False, group_friendly=True,
    amenities=["Parking", "Pool"], amenity_categories=["General"], is_published=True, last_synced_at=datetime(2026, 5, 29, 4, 18, 51),
    policy=json.dumps({"pets_allowed": True, "pets_policy_text": "Pets are allowed", "adults_only_checkin": True,
                       "checkin_age_policy_text": "Only adults are allowed to check in", "minimum_checkin_age": 18, "free_cancellation": True}),
    property_flags=json.dumps({"work_friendly_home": False, "long_stay_friendly_home": True, "is_new": True}),
)


def table(spark, *rows):
    names = sorted({k for r in rows for k in r})
    schema = schemas.T.StructType([schemas.LISTING_SCHEMA[n] for n in names])
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    return evolve(df, schemas.LISTING_SCHEMA).select(*schemas.LISTING_COLUMNS)


def test_search_document(spark):
    d = docs.search_documents(table(spark, ROW)).first().asDict()
    assert len(d) == 28
    assert d["id"] == "BC-1812" and d["lonlat"] == [45.8185, 32.5128] and d["usd_price"] == 199.99 and d["review_score_general"] == 8.5
    assert d["property_attributes"] == ["Group Friendly", "Free Cancellation"] and d["property_flags"]["is_new"] is True
    assert d["updated_at"] == "2026-05-29T04:18:51" and d["created_at"] is None and d["published"] is True
    bare = docs.search_documents(table(spark, dict(external_id="x"))).first()
    assert (bare["lonlat"], bare["usd_price"], bare["property_flags"], bare["property_attributes"]) == (None, None, {}, [])


def test_export_document_and_embedding_text(spark):
    d = docs.export_documents(table(spark, ROW)).first().asDict(recursive=True)
    assert (d["Lat"], d["Lng"], d["LocationID"]) == ("32.5128", "45.8185", "L-77")
    assert d["Partner"]["Policies"] == {"CancellationPolicy": "Free cancellation", "CheckinPolicy": "Only adults are allowed to check in", "PetPolicy": "Pets are allowed"}
    p = d["Property"]
    assert p["Image"] == {"Count": 2, "Images": ["1.jpg", "2.jpg"]} and p["ImageAnalysis"] == [] and p["OtherPolicy"] is None
    assert (p["AdultOnly"], p["IsPetFriendly"], p["LongStayFriendlyHome"], p["WorkFriendlyHome"], p["Price"]) == (True, True, True, False, 199.99)
    frame = docs.export_documents(table(spark, ROW, dict(external_id="b"), dict(external_id="c", property_name="Cabin", policy='{"pets_allowed": true, "adults_only_checkin": true}')))
    texts = {r["ID"]: r["t"] for r in frame.select("ID", docs.embedding_text(frame).alias("t")).collect()}
    assert texts["BC-1812"] == "Casa Lumen | Country House | Al Kut | Iraq | General | Parking, Pool | pet friendly | adults only | long stay friendly"
    assert texts["b"] == "" and texts["c"] == "Cabin | pet friendly | adults only"
    bare = frame.where("ID = 'b'").first()
    assert bare["Partner"]["Policies"]["CancellationPolicy"] == "No free cancellation" and bare["Property"]["IsPetFriendly"] is False


def test_json_export_keeps_nulls_and_days_apart(spark, tmp_path):
    rows = table(spark, ROW, dict(external_id="b"))
    export_json(rows, str(tmp_path), "20260714")
    export_json(rows.limit(1), str(tmp_path), "20260715")
    export_json(rows, str(tmp_path), "20260714")  # written again
    schema = docs.export_documents(rows).schema
    back = exported_documents(spark, str(tmp_path), "20260714", schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.export_documents(rows).collect()))
    assert exported_documents(spark, str(tmp_path), "19990101", schema).count() == 0
    assert '"OtherPolicy":null' in "".join(p.read_text() for p in (tmp_path / "date=20260714").glob("part-*"))


def test_history_store(spark, tmp_path):
    def day(d, hour, price, **more):
        return {**ROW, "last_synced_at": datetime(2026, 1, d, hour), "price": Decimal(price), **more}

    store = KeyedStore(spark, str(tmp_path / "kv"), ["property_id", "timestamp"], docs.kv_items(table(spark, ROW)).schema, buckets=4)
    ids = spark.createDataFrame([("1812",), ("7",)], "id string")
    rows = table(
        spark, day(1, 1, "1"), day(1, 9, "2"), day(2, 1, "3"), {**ROW, "last_synced_at": None}, day(3, 1, "9", external_id=""),
        day(1, 1, "5", external_id="BC-7", feed_provider_id="7"), day(4, 1, "6", feed_provider_id="not listed"),
    )
    export_history(rows, ids, store)
    history = {(r["property_id"], r["timestamp"]): float(r["usd_price"]) for r in store.read().collect()}
    assert history == {("BC-1812", "20260101"): 2.0, ("BC-1812", "20260102"): 3.0, ("BC-7", "20260101"): 5.0}
    export_history(table(spark, day(2, 5, "30")), ids, store)
    one = spark.createDataFrame([("BC-1812",)], "property_id string")
    assert sorted(float(r["usd_price"]) for r in store.lookup(one).collect()) == [2.0, 30.0]
    key = spark.createDataFrame([("BC-7", "20260101")], "property_id string, timestamp string")
    assert [float(r["usd_price"]) for r in store.lookup(key).collect()] == [5.0]
    export_history(table(spark, day(2, 5, "30")), ids.where("id = 'none'"), store)
    assert store.read().count() == 3


def folder_bytes(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_store_appends_commits_and_compacts(spark, tmp_path):
    root = tmp_path / "store"
    schema = spark.createDataFrame([], "k string, part int, v string").schema
    store = KeyedStore(spark, str(root), ["k", "part"], schema, buckets=4, compact_after=3)
    assert store.read().count() == 0 and store.lookup(spark.createDataFrame([("1",)], "k string")).count() == 0
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("part"), F.md5(F.col("id").cast("string")).alias("v"))
    store.upsert(rows)
    before = folder_bytes(root)
    store.upsert(rows.where("k < 20").withColumn("v", F.lit("new")))
    assert folder_bytes(root) - before < before / 50
    # A batch that died before its commit, and the same batch replayed.
    (root / "data/torn").mkdir()
    (root / "data/torn/part-0.parquet").write_text("torn")
    store.upsert(rows.where("k < 20").withColumn("v", F.lit("new")))
    assert KeyedStore(spark, str(root), ["k", "part"], schema, buckets=99).buckets == 4
    got = {r["k"]: r["v"] for r in store.lookup(spark.createDataFrame([("7",), ("70",), ("none",)], "k string")).collect()}
    assert got["7"] == "new" and set(got) == {"7", "70"} and len(got["70"]) == 32
    expected = {(r["k"], r["v"]) for r in store.read().collect()}
    store.upsert(rows.where("k = 5").withColumn("v", F.lit("last")))  # the fourth commit: compacted
    assert json.loads(store.log.text(store.log.numbers()[-1]))["base"]
    assert {(r["k"], r["v"]) for r in store.read().collect()} == (expected - {("5", "new")}) | {("5", "last")}
    with pytest.raises(FileExistsError):
        store.log.commit(1, "{}")


def test_partition_writer_runs_on_the_workers(spark, tmp_path):
    target = str(tmp_path)

    def writer(rows):
        import uuid

        with open(f"{target}/{uuid.uuid4()}", "w") as f:
            f.writelines(f"{r['id']}\n" for r in rows)

    write_partitions(spark.range(50).repartition(3), writer)
    assert sorted(int(x) for p in tmp_path.iterdir() for x in p.read_text().split()) == list(range(50))


def test_vector_points(spark, tmp_path):
    rows = table(spark, ROW, {**ROW, "external_id": "BC-2", "property_name": "Other", "is_published": False}, dict(external_id="no text"), {**ROW, "external_id": None})
    exported = docs.export_documents(rows)
    texts = exported.select(docs.embedding_text(exported).alias("text")).where("text <> ''").distinct()
    vectors = texts.select("text", F.array(F.length("text").cast("float"), F.lit(1.0).cast("float")).alias("vector"))
    store = KeyedStore(spark, str(tmp_path / "points"), ["point_id"], docs.vector_points(exported, vectors).schema, buckets=2)
    assert export_points(exported, vectors, store) == 2
    assert export_points(exported, vectors, store) == 2  # the same ids again
    some = vectors.where(F.col("text").contains("Other"))
    lacking = docs.skipped_documents(exported, some.union(vectors.select("text", F.lit(None))))
    assert sorted((r["external_id"] or "", r["reason"]) for r in lacking.collect()) == [("", "no id"), ("BC-1812", "no vector"), ("no text", "no text")]
    stored = {r["payload"]["external_id"]: r for r in store.read().collect()}
    assert set(stored) == {"BC-1812", "BC-2"} and len(stored["BC-2"]["payload"]) == 18
    assert stored["BC-2"]["payload"]["is_pet_friendly"] is True
    found = similar_listings(store.read()).collect()
    assert [(r["source_id"], r["external_id"], r["rank"]) for r in found] == [("BC-2", "BC-1812", 1)]


SITE = Site("https://s.example", {"en": "https://s.example", "en-CA": "https://s.example.ca"})
RUN = F.lit(datetime(2026, 7, 14, 9)).cast("timestamp")
SITEMAP_DDL = "external_id string, property_slug string, last_synced_at timestamp, feature_image string, images array<string>"


def test_url_block(spark):
    rows = spark.createDataFrame([("BC-1", "a&b", datetime(2026, 7, 14, 9, 12, 31), "f.jpg?x=1&y=2", ["a.jpg", "", None, "f.jpg?x=1&y=2", "a.jpg"])], SITEMAP_DDL)
    assert url_blocks(rows, SITE, RUN).first()["block"] == (
        "  <url>\n    <loc>https://s.example/property/a&amp;b/BC-1</loc>\n    <lastmod>2026-07-14T09:12:31</lastmod>\n"
        '    <xhtml:link rel="alternate" hreflang="en" href="https://s.example/property/a&amp;b/BC-1"/>\n'
        '    <xhtml:link rel="alternate" hreflang="en-CA" href="https://s.example.ca/property/a&amp;b/BC-1"/>\n'
        "    <image:image>\n      <image:loc>f.jpg?x=1&amp;y=2</image:loc>\n    </image:image>\n"
        "    <image:image>\n      <image:loc>a.jpg</image:loc>\n    </image:image>\n  </url>\n"
    )
    bare = url_blocks(spark.createDataFrame([("BC-2", None, None, None, None)], SITEMAP_DDL), SITE, RUN).first()["block"]
    assert "/property/listing/BC-2<" in bare and "<lastmod>2026-07-14T09:00:00<" in bare and "image" not in bare


def test_files_roll_over_by_count_and_size(spark):
    blocks = spark.range(1000).select(F.format_string("%04d", "id").alias("external_id"), F.repeat(F.lit("é"), (F.col("id") % 50).cast("int") + 1).alias("block"))
    by_count = [(r["external_id"], r["file_no"]) for r in assign_files(blocks, max_urls=300).orderBy("external_id").collect()]
    assert [n for _, n in by_count] == [i // 300 + 1 for i in range(1000)]
    cap = len(HEADER) + 700
    sized = assign_files(blocks, max_urls=300, max_bytes=cap).orderBy("position").collect()
    assert [r["external_id"] for r in sized] == [f"{i:04d}" for i in range(1000)]
    sizes, counts = {}, {}
    for r in sized:
        sizes[r["file_no"]] = sizes.get(r["file_no"], len(HEADER)) + len(r["block"].encode())
        counts[r["file_no"]] = counts.get(r["file_no"], 0) + 1
    assert max(sizes.values()) <= cap and max(counts.values()) <= 300
    assert sorted(sizes) == list(range(1, len(sizes) + 1)) and [r["file_no"] for r in sized] == sorted(r["file_no"] for r in sized)


def greedy(sizes, max_urls, max_bytes):
    """File of each row by filling files one row after another."""
    out, number, count, used = [], 1, 0, len(HEADER)
    for size in sizes:
        if count and (count >= max_urls or used + size > max_bytes):
            number, count, used = number + 1, 0, len(HEADER)
        out.append(number)
        count, used = count + 1, used + size
    return out


@pytest.mark.parametrize("max_urls, room", [(300, 700), (7, 200), (50, 1), (1, 10), (13, 333), (1000, 2000), (8, 60)])
def test_files_are_filled_greedily(spark, max_urls, room):
    blocks = spark.range(400).select(F.format_string("%04d", "id").alias("external_id"), F.repeat(F.lit("x"), (F.col("id") * 37 % 61).cast("int")).alias("block"))
    filed = assign_files(blocks, max_urls, len(HEADER) + room).orderBy("position").collect()
    assert [r["external_id"] for r in filed] == [f"{i:04d}" for i in range(400)]
    assert [r["file_no"] for r in filed] == greedy([i * 37 % 61 for i in range(400)], max_urls, len(HEADER) + room)
    assert assign_files(blocks.limit(0), max_urls, len(HEADER) + room).count() == 0


def test_sitemap_files_and_index(spark, tmp_path):
    folder = str(tmp_path / "maps")
    rows = spark.createDataFrame([(f"BC-{i}", f"s{i}", datetime(2026, 7, 14), f"{i}.jpg", []) for i in range(5)], SITEMAP_DDL)
    assert write_sitemaps(rows.limit(0), folder, "none", SITE, RUN) == []
    assert write_root_index(spark, folder, SITE, RUN) is None
    names = write_sitemaps(rows, folder, "listing", SITE, RUN, max_urls=2)
    assert sorted(names) == ["listing-2.xml.gz", "listing-3.xml.gz", "listing.xml.gz"]
    bodies = [gzip.decompress((tmp_path / "maps" / n).read_bytes()).decode() for n in ("listing.xml.gz", "listing-2.xml.gz", "listing-3.xml.gz")]
    blocks = [r["block"] for r in url_blocks(rows, SITE, RUN).orderBy("external_id").collect()]
    assert bodies == [HEADER + "".join(blocks[i : i + 2]) + FOOTER for i in (0, 2, 4)]
    for _ in range(2):  # the index does not list itself
        assert write_root_index(spark, folder, SITE, RUN) == "sitemap_index.xml.gz"
    index = gzip.decompress((tmp_path / "maps" / "sitemap_index.xml.gz").read_bytes()).decode()
    listed = [line.strip() for line in index.splitlines() if "<loc>" in line]
    assert listed == [f"<loc>https://s.example/{n}</loc>" for n in ("listing-2.xml.gz", "listing-3.xml.gz", "listing.xml.gz")]
    assert index.startswith('<?xml version="1.0" encoding="UTF-8"?>\n<sitemapindex ') and index.endswith("</sitemapindex>\n")


@pytest.fixture
def town(spark):
    def at(i, lat, lon, published=True):
        return {**ROW, "external_id": f"BC-{i}", "feed_provider_id": str(i), "latlon": f"SRID=4326;POINT ({lon} {lat})", "is_published": published}

    return table(spark, at(1, 10.0, 20.0), at(2, 10.01, 20.0), at(3, 10.02, 20.0, False), at(4, 50.0, 20.0), {**at(5, 0, 0), "latlon": None})


def test_nearby_flows(spark, town, tmp_path):
    found = docs.search_documents(town)
    near = {(r["source_id"], r["id"]): r["distance_km"] for r in nearby_listings(found).collect()}
    assert near == {("BC-1", "BC-2"): 1.11, ("BC-2", "BC-1"): 1.11, ("BC-3", "BC-2"): 1.11, ("BC-3", "BC-1"): 2.22}
    one = spark.createDataFrame([("BC-1",)], "id string")
    assert [r["id"] for r in nearby_listings(found, one, published_only=False).orderBy("rank").collect()] == ["BC-2", "BC-3"]
    place = nearby_place(found, 10.011, 20.0, 5, 1).collect()
    assert [(r["id"], r["distance_km"]) for r in place] == [("BC-2", 0.11)]
    assert nearby_sitemap(town, str(tmp_path), SITE, RUN) == ["nearby-sitemap.xml.gz"]
    body = gzip.decompress((tmp_path / "nearby-sitemap.xml.gz").read_bytes()).decode()
    assert body.count("<url>") == 2 and body.count("<image:loc>f.jpg<") == 2
    assert listing_sitemap(town, str(tmp_path), SITE, RUN) == ["property-sitemap.xml.gz"]
    assert gzip.decompress((tmp_path / "property-sitemap.xml.gz").read_bytes()).decode().count("<url>") == 4
    assert nearby_sitemap_rows(spark.createDataFrame([], "id string"), found).count() == 0


def test_change_stream(spark, town, tmp_path):
    events = tmp_path / "events"
    events.mkdir()
    (events / "1.json").write_text('{"feed_provider_ids": ["1", "2", "none"], "date": "20260714"}\n{broken\n[1]\n{"date": "20260714"}\n{"feed_provider_ids": []}\n')
    store = KeyedStore(spark, str(tmp_path / "docs"), ["id"], docs.search_documents(town).schema, buckets=2)
    current = {"rows": town}

    def run():
        run_change_stream(
            spark, str(events), lambda: current["rows"], store, str(tmp_path / "rejects"), str(tmp_path / "state"), max_files=1
        ).awaitTermination()

    run()
    assert sorted(r["id"] for r in store.read().collect()) == ["BC-1", "BC-2"]
    assert sorted(r["value"] for r in spark.read.json(str(tmp_path / "rejects")).collect()) == ["[1]", "{broken"]
    # Rows are read anew, and an event that comes twice does no harm.
    current["rows"] = town.withColumn("city", F.lit("Moved"))
    (events / "2.json").write_text('{"feed_provider_ids": ["2"]}\n{"feed_provider_ids": ["2"]}\n')
    run()
    assert {r["id"]: r["city"] for r in store.read().collect()} == {"BC-1": "Al Kut", "BC-2": "Moved"}


def test_files_filled_in_few_steps_are_the_same(spark, monkeypatch):
    """Runs of one small file each took a group and a written join for every doubling."""
    from lodgeframe.operators import sitemap

    blocks = spark.range(900).selectExpr("lpad(id, 5, '0') external_id", "repeat('x', cast(50 + id * 37 % 400 as int)) block")
    cuts = []
    monkeypatch.setattr(sitemap, "cut_lineage", lambda df: cuts.append(1) or df.checkpoint())

    def filed():
        cuts.clear()
        return {(r["external_id"], r["position"], r["file_no"]) for r in sitemap.assign_files(blocks, 7, 2_000).collect()}, len(cuts)

    few, steps = filed()
    monkeypatch.setattr(sitemap, "RUN_ROWS", 1)
    assert filed()[0] == few and len({f for _, _, f in few}) > 100
    assert steps <= 5


def test_many_short_sitemaps_are_read_by_few_tasks(spark, tmp_path):
    """Each few files were a task of their own, some 7,000 of them over 28,000 files."""
    from lodgeframe.queries import QUERIES

    spark.range(4000).selectExpr("id c_custkey", "concat('Name ', id) c_name", "int(id % 2) c_nationkey", "double(id) c_acctbal", "'BUILDING' c_mktsegment").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(2).selectExpr("int(id) n_nationkey", "concat('N', id) n_name", "0 n_regionkey").coalesce(1).write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1).selectExpr("int(id) r_regionkey", "'R' r_name").write.parquet(f"{tmp_path}/region.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        found = QUERIES["sitemap_written"](spark, str(tmp_path))
        assert found.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism < found.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_are_moved_several_at_once(spark, tmp_path):
    from lodgeframe.sources.paths import matches, rename_all

    (tmp_path / "from").mkdir()
    (tmp_path / "to").mkdir()
    for i in range(40):
        (tmp_path / "from" / f"a, {i}").write_text(str(i))
    (tmp_path / "to" / "7").write_text("old")
    found = matches(spark, f"{tmp_path}/from/*")
    assert len(found) == 40 and found == sorted(found)
    rename_all(spark, {p: f"{tmp_path}/to/{p.rsplit(' ', 1)[1]}" for p in found})
    assert {p.name: p.read_text() for p in (tmp_path / "to").iterdir() if not p.name.startswith(".")} == {str(i): str(i) for i in range(40)}
    assert matches(spark, f"{tmp_path}/from/*") == [] and matches(spark, f"{tmp_path}/none/*") == []
    rename_all(spark, {})
    with pytest.raises(Exception, match="from/a|could not move"):
        rename_all(spark, {found[0]: f"{tmp_path}/to/again"})


def test_similar_listings_reads_its_points_once(spark):
    """Points, a join of documents and vectors, were made anew for keys, members, vectors and payloads."""
    made = spark.sparkContext.accumulator(0)

    def vector(n):
        made.add(1)
        return [float(n % 7 + 1), float(n % 5), 1.0]

    payload = F.struct(F.concat(F.lit("BC-"), F.col("id").cast("string")).alias("external_id"), (F.col("id") % 3 > 0).alias("published"))
    points = spark.range(60).select(F.udf(vector, "array<double>")("id").alias("vector"), payload.alias("payload"))
    found = similar_listings(points, k=2).collect()
    assert len(found) == 120 and all(r["published"] for r in found)
    assert made.value <= 120
