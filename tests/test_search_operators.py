"""Nearest-N, vector search and duplicates against brute force."""

import json
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import duplicates, similar
from lodgeframe.operators.media import best_images, image_analysis, ranked_images
from lodgeframe.operators.nearest import nearest, within_radius
from lodgeframe.operators.similar import similar_all, similar_lsh, similar_to
from lodgeframe.operators.text_vectors import model_vectors, tfidf_vectors
from lodgeframe.plans.duplicates import partner_duplicates, ranked_partner_duplicates
from lodgeframe.schemas import LISTING_SCHEMA
from lodgeframe.sources.tables import evolve


@pytest.fixture(scope="module")
def places():
    """A third of all points in one street, a sixth at one spot, some around a pole and the date line."""
    rng = np.random.default_rng(1)
    n = 900
    lat = np.concatenate([rng.uniform(10, 10.3, n // 3), 10.1 + rng.normal(0, 0.0005, n // 3), np.full(n // 6, 10.2), -89.99 + rng.uniform(0, 0.02, n // 12), rng.uniform(-0.1, 0.1, n // 12)])
    lon = np.concatenate([rng.uniform(20, 20.3, n // 3), 20.1 + rng.normal(0, 0.0005, n // 3), np.full(n // 6, 20.2), rng.uniform(-180, 180, n // 12), (360 + rng.uniform(-0.1, 0.1, n // 12)) % 360 - 180])
    return pd.DataFrame({"id": np.arange(len(lat)), "lat": lat, "lon": lon})


def brute_nearest(p, radius, limit):
    la, lo, out = np.radians(p.lat.to_numpy()), np.radians(p.lon.to_numpy()), set()
    for i in range(len(p)):
        a = np.sin((la - la[i]) / 2) ** 2 + np.cos(la[i]) * np.cos(la) * np.sin((lo - lo[i]) / 2) ** 2
        d = 2 * 6371 * np.arcsin(np.sqrt(np.minimum(1, a)))
        ok = np.nonzero((d <= radius) & (np.arange(len(p)) != i))[0]
        for rank, j in enumerate(ok[np.lexsort((ok, np.round(d[ok], 6)))][:limit]):
            out.add((i, int(j), rank + 1))
    return out


@pytest.mark.parametrize("radius, limit, crowd", [(5, 20, 10**9), (5, 3, 8), (50, 20, 32)])
def test_nearest_equals_brute_force(spark, places, radius, limit, crowd, monkeypatch):
    monkeypatch.setattr("lodgeframe.operators.nearest.UNSPLIT", crowd)
    df = spark.createDataFrame(places)
    got = {(r["source_id"], r["id"], r["rank"]) for r in nearest(df, df, radius, limit, crowd).collect()}
    assert got == brute_nearest(places, radius, limit)


def test_nearest_writes_no_pairs(spark, places, monkeypatch):
    """Few plans however deep a crowd is: the cells were refined level by level, each written, and pairs were shuffled."""
    from lodgeframe.operators import nearest as module

    cuts = []
    monkeypatch.setattr(module, "cut_lineage", lambda df: cuts.append(1) or df.checkpoint())
    crowd = places.assign(lat=10.0 + places.index % 31 * 1e-7, lon=20.0 + places.index // 31 * 1e-7)
    df = spark.createDataFrame(crowd)
    found = nearest(df, df, 5, 3, 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(cuts) <= 4 and "Window" not in plan
    assert {(r["source_id"], r["id"], r["rank"]) for r in found.collect()} == brute_nearest(crowd, 5, 3)


def test_nearest_of_sparse_sources_beside_a_crowd_and_repeated_rows(spark):
    rng = np.random.default_rng(3)
    crowd = pd.DataFrame({"id": [f"t{i}" for i in range(3000)], "lat": 10 + rng.normal(0, 0.002, 3000), "lon": 20 + rng.normal(0, 0.002, 3000)})
    far = pd.DataFrame({"id": ["s1", "s2", "s2", None], "lat": [10.03, -40.0, 10.0, 10.0], "lon": [20.0, 20.0, 20.03, 20.0]})
    rows = nearest(spark.createDataFrame(far), spark.createDataFrame(crowd), 5, 4, 16).collect()
    got = {s: [r["id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["source_id"] == s] for s in ("s1", "s2")}
    for s, (lat, lon) in {"s1": (10.03, 20.0), "s2": (10.0, 20.03)}.items():
        here = pd.concat([pd.DataFrame({"id": [s], "lat": [lat], "lon": [lon]}), crowd.sort_values("id")], ignore_index=True)
        assert got[s] == [here["id"][j] for i, j, _ in sorted(brute_nearest(here, 5, 4), key=lambda x: x[2]) if i == 0]


def test_nearest_skips_rows_without_a_point(spark):
    df = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0, 20.001), (3, None, 20.0), (4, 95.0, 20.0)], "id int, lat double, lon double")
    rows = nearest(df, df, 5, 20).collect()
    assert sorted((r["source_id"], r["id"], r["distance_km"]) for r in rows) == [(1, 2, 0.11), (2, 1, 0.11)]


def test_within_radius_of_one_place(spark, places):
    got = within_radius(spark.createDataFrame(places), 10.1, 20.1, 5, 7).collect()
    here = pd.concat([pd.DataFrame({"id": [-1], "lat": [10.1], "lon": [20.1]}), places], ignore_index=True)
    expected = [j - 1 for i, j, _ in sorted(brute_nearest(here, 5, 7), key=lambda x: x[2]) if i == 0]
    assert [r["id"] for r in got] == expected


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6))
    v = np.concatenate([centres[rng.integers(0, 8, 150)] + rng.normal(size=(150, 6)) * 0.02, np.tile(centres[0], (80, 1)), rng.normal(size=(30, 6)), np.zeros((2, 6))])
    v = v.astype(np.float32)
    unit = v.astype(float)
    norms = np.linalg.norm(unit, axis=1, keepdims=True)
    unit = np.divide(unit, norms, out=np.zeros_like(unit), where=norms > 0)
    return v, np.arange(len(v)) % 3 != 0, np.round(unit @ unit.T, 6) + 0.0


def brute_similar(vectors, k, published_only, sources=None):
    v, published, scores = vectors
    out = set()
    for i in range(len(v)) if sources is None else sources:
        ids = np.nonzero((np.arange(len(v)) != i) & (published | (not published_only)))[0]
        for rank, j in enumerate(ids[np.lexsort((ids, -scores[i, ids]))][:k]):
            out.add((i, int(j), rank + 1))
    return out


def vector_table(spark, vectors):
    v, published, _ = vectors
    return spark.createDataFrame([(i, v[i].tolist(), bool(published[i])) for i in range(len(v))], "id long, vector array<float>, published boolean")


def triples(df):
    return {(r["source_id"], r["id"], r["rank"]) for r in df.collect()}


def test_super_blocks_meet_once_and_hand_on_one_row_a_query(spark, monkeypatch):
    """Both sides were copied for each ordered pair of super-blocks, and every candidate was a row with two long keys."""
    from lodgeframe.operators import similar

    rng = np.random.default_rng(5)
    points = rng.normal(size=(900, 8))
    frame = spark.createDataFrame([(2**60 + n, [float(x) for x in v], n % 3 > 0) for n, v in enumerate(points)], "id long, vector array<double>, published boolean")
    seen, apply = [], type(frame.groupBy("id")).applyInPandas

    def counted(grouped, fn, schema):
        out = apply(grouped, fn, schema)
        if "c_key" in schema:
            seen.append((grouped._df.count(), out.count()))
        return out

    monkeypatch.setattr(type(frame.groupBy("id")), "applyInPandas", counted)
    got = {}
    for r in similar.similar_all(frame, 4, False).collect():
        got.setdefault(r["source_id"], {})[r["rank"]] = r["id"]
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 6)
    np.fill_diagonal(scores, -2)
    best = np.argsort(-scores, axis=1, kind="stable")[:, :4]
    assert got == {2**60 + n: {i + 1: 2**60 + int(j) for i, j in enumerate(row)} for n, row in enumerate(best)}
    # 30 pivots, of which 6 are of the first level: at most 6 copies of a vector and 6 rows of a query.
    assert seen and all(copies <= 900 * 6 and rows <= 900 * 6 for copies, rows in seen)


@pytest.mark.parametrize("published_only, block_rows", [(True, 4096), (False, 16)])
def test_similar_all_equals_brute_force(spark, vectors, published_only, block_rows):
    assert triples(similar_all(vector_table(spark, vectors), 5, published_only, block_rows)) == brute_similar(vectors, 5, published_only)


def test_hyperplane_buckets_reach_nine_tenths(spark):
    """Recall on clustered vectors, whatever the size of a block; found scores are exact."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((60, 32))
    v = np.repeat(centres, 10, 0) + 0.25 * rng.standard_normal((600, 32))
    v[5] = v[4]
    frame = vector_table(spark, (v.astype(np.float32), np.ones(len(v), bool), None))
    unit = v.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 6)
    exact = {t[:2] for t in brute_similar((v, np.ones(len(v), bool), scores), 5, True)}
    for block_rows in (4096, 20):
        found = similar_lsh(frame, 5, block_rows=block_rows).collect()
        assert len({(r["source_id"], r["id"]) for r in found} & exact) >= 0.9 * len(exact)
        assert len({(r["source_id"], r["id"]) for r in found}) == len(found)
        assert all(abs(r["score"] - scores[r["source_id"], r["id"]]) <= 2e-6 for r in found)
    assert similar_lsh(frame.limit(0)).count() == 0


def test_pivots_leave_out_far_blocks():
    rng = np.random.default_rng(7)
    centres = np.linalg.qr(rng.standard_normal((32, 32)))[0]
    unit = np.repeat(centres, 30, 0) + 0.02 * rng.standard_normal((960, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    pivots = similar.Pivots(rng.permutation(unit)[:160])
    best, wide, cell, narrow = pivots.place(unit)
    assert (pivots.of[cell] == best).all() and (narrow <= wide + 1e-6).all()
    near = pd.DataFrame({"cell": cell, "angle": narrow, "w": 1}).sort_values(["cell", "angle"]).groupby("cell").head(6)
    summary = pd.DataFrame({"cell": cell, "angle": narrow}).groupby("cell")["angle"].max().rename("queries").reset_index()
    reach = similar.Reach(pivots, summary.assign(held=summary["queries"]), near, 6)
    order = np.argsort(-(unit @ unit.T), axis=1)[:, :6]
    for i in range(0, 960, 7):
        visited = reach.cells(pivots, cell[i], np.unique(cell))
        assert set(cell[order[i]]) <= set(visited)
    assert np.mean([len(reach.cells(pivots, c, np.unique(cell))) for c in np.unique(cell)]) < 0.5 * len(np.unique(cell))


def test_similar_to_equals_brute_force(spark, vectors, monkeypatch):
    table = vector_table(spark, vectors)
    ids = spark.createDataFrame([(1,), (100,), (200,), (10**6,)], "id long")
    assert triples(similar_to(table, ids, 4)) == brute_similar(vectors, 4, True, [1, 100, 200])
    monkeypatch.setattr("lodgeframe.operators.similar.QUERY_GROUP", 1)  # more queries than one scan takes
    monkeypatch.setattr("lodgeframe.operators.similar.BLOCK_ROWS", 50)
    assert triples(similar_to(table, ids, 4)) == brute_similar(vectors, 4, True, [1, 100, 200])
    kind = table.schema["vector"].dataType.simpleString()
    odd = spark.createDataFrame([(901,), (902,), (903,)], "id long").withColumn("vector", F.expr(f"CAST(CASE id WHEN 902 THEN array() WHEN 903 THEN array(1, NULL) END AS {kind})"))
    with_odd = table.unionByName(odd.withColumn("published", F.lit(True)).select(table.columns))
    for found in (similar_to(with_odd, ids.union(odd.select("id")), 4), similar_all(with_odd, 4).where("source_id IN (1, 100, 200)")):
        assert triples(found) == brute_similar(vectors, 4, True, [1, 100, 200])
    assert similar_to(table, ids.where("id > 1000"), 4).count() == 0


FIELDS = "external_id string, id string, latlon string, property_name string, property_type string, location_display string, property_description string, other_policy string, bedroom_count int, bathroom_count int"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def made_up_side(rng, n, prefix):
    words = [f"w{i}" for i in range(60)]

    def text(k):
        return " ".join(words[int(min(59, rng.exponential(12)))] for _ in range(k))

    rows = []
    for i in range(n):
        site = int(rng.integers(0, 4))
        point = f"SRID=4326;POINT ({20 + site * 0.01 + rng.uniform(0, 0.0012)} {(0 if site == 0 else 45) + rng.uniform(0, 0.0012)})"
        rows.append((
            f"{prefix}{i}" if i % 7 else None, f"alt{prefix}{i}", point if i % 11 else "bad", text(3), ["House", "Flat", "Big House", ""][int(rng.integers(0, 4))],
            text(2), text(8) if i % 5 else None, "No smoking", int(rng.integers(1, 3)), 1))
    return rows + [(r[1] + "copy", *r[1:]) for r in rows[: n // 5]]


def word_cosine(a, b):
    if not a or not b:
        return 0.0
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    return sum(x[w] * y[w] for w in x) / math.sqrt(sum(n * n for n in x.values()) * sum(n * n for n in y.values()))


def brute_duplicates(own, partner, distance_m, threshold):
    point, out = re.compile(r"POINT \(([-\d.]+) ([-\d.]+)\)"), {}
    for x in (dict(zip(NAMES, r)) for r in own):
        for y in (dict(zip(NAMES, r)) for r in partner):
            p, q = point.search(x["latlon"]), point.search(y["latlon"])
            if not p or not q:
                continue
            (lo1, la1), (lo2, la2) = ([math.radians(float(v)) for v in m.groups()] for m in (p, q))
            h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
            if 2 * 6371000 * math.asin(math.sqrt(h)) > distance_m:
                continue
            w = duplicates.FIELD_WEIGHTS
            score = sum(w[f] * (float(x[f] == y[f]) if f in duplicates.NUMERIC_FIELDS else word_cosine(x[f], y[f])) for f in w)
            if round(score, 4) >= threshold:
                out[(x["external_id"] or x["id"], y["external_id"] or y["id"])] = round(score, 4)
    return out


@pytest.mark.parametrize("distance_m, threshold, tile_rows", [(100, 0.75, 1_024), (100, 0.75, 7), (100, 0.6, 20), (300, 0.4, 7)])
def test_duplicates_equal_brute_force(spark, monkeypatch, distance_m, threshold, tile_rows):
    monkeypatch.setattr(duplicates, "TILE_ROWS", tile_rows)
    rng = np.random.default_rng(3)
    own, partner = made_up_side(rng, 60, "A"), made_up_side(rng, 50, "B")
    partner += [(f"Bc{i}", *own[i][1:]) for i in rng.choice(len(own), 25, replace=False)]
    found = duplicates.find_duplicates(spark.createDataFrame(own, FIELDS), spark.createDataFrame(partner, FIELDS), distance_m, threshold)
    got = {(r["source_id"], r["candidate_id"]): r["scores"]["overall_score"] for r in found.collect()}
    expected = brute_duplicates(own, partner, distance_m, threshold)
    assert set(got) == set(expected) and len(got) > 20
    assert all(abs(got[k] - expected[k]) <= 1e-4 for k in got)


def test_crowded_cell_is_copied_for_few_tiles(spark):
    """5,000 listings a side at one address: each was copied once for every 1,024 of the other side, texts and all."""
    sides = [spark.range(5000).selectExpr(f"concat('{p}', id) external_id", "'POINT (7 45)' latlon", "'House' property_name", "concat('a house ', id) property_description") for p in "op"]
    contents = [duplicates._distinct_contents(duplicates._listing_contents(s, duplicates.FIELD_WEIGHTS), duplicates.FIELD_WEIGHTS, None) for s in sides]
    copies = duplicates._tiled(*contents, 100).groupBy("_side", "content").count()
    cells = len(duplicates._reached_cells(sides[1].limit(1).selectExpr("45d lat", "7d lon"), 400, 100.001).collect())
    assert copies.agg(F.max("count")).first()[0] <= cells


def test_duplicate_pairs_are_not_shuffled(spark):
    """Each pair was shuffled twice for the ids of its listings, and each text once more than for its tile."""
    found = duplicates.find_duplicates(*(spark.createDataFrame(made_up_side(np.random.default_rng(k), 40, p), FIELDS) for k, p in enumerate("AB")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange hashpartitioning") == 1


def test_tiles_grow_where_a_cell_would_be_copied_often(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "TILE_ROWS", 4)
    sides = [spark.range(300).selectExpr(f"concat('{p}', id) external_id", "'POINT (7 45)' latlon", "concat('a house ', id) property_description") for p in "op"]
    contents = [duplicates._distinct_contents(duplicates._listing_contents(s, duplicates.FIELD_WEIGHTS), duplicates.FIELD_WEIGHTS, None) for s in sides]
    cells = len(duplicates._reached_cells(sides[1].limit(1).selectExpr("45d lat", "7d lon"), 400, 100.001).collect())
    # 300 listings are 10 tiles of 32, but 3 of 128.
    assert duplicates._tiled(*contents, 100).where("_side = 0").groupBy("content").count().agg(F.max("count")).first()[0] == 3
    assert duplicates._tiled(*contents, 100).where("_side = 1").groupBy("content").count().agg(F.max("count")).first()[0] <= 3 * cells


def test_equal_listings_give_all_their_pairs(spark):
    """Equal listings are collapsed in their tile; each pair of ids is a row, repeated and missing ids too."""
    same = ("'POINT (7 45)' latlon", "'House' property_name", "'A house' property_description", "'x' property_type", "'y' location_display", "'z' other_policy", "1 bedroom_count", "2 bathroom_count")
    own = spark.range(150).selectExpr("CASE WHEN id > 0 THEN concat('o', id % 140) END external_id", *same)
    partner = spark.range(120).selectExpr("concat('p', id) external_id", *same)
    found = duplicates.find_duplicates(own, partner)
    pairs = Counter((r["source_id"], r["candidate_id"]) for r in found.collect())
    ids = Counter(f"o{i % 140}" if i else None for i in range(150))
    assert pairs == {(s, f"p{c}"): n for s, n in ids.items() for c in range(120)}


def test_duplicates_over_several_matrices_of_a_tile(spark, monkeypatch):
    def side(p):
        return spark.range(60).selectExpr(f"concat('{p}', id) external_id", "'POINT (7 45)' latlon", "concat('House ', id % 7) property_name", "concat('a house ', id) property_description", "'x' property_type", "'y' location_display", "1 bedroom_count", "2 bathroom_count")

    def found():
        return {tuple(r) for r in duplicates.find_duplicates(side("o"), side("p")).select("source_id", "candidate_id", "distance_m", "scores.overall_score").collect()}

    whole = found()
    monkeypatch.setattr(duplicates, "TILE_ROWS", 9)
    assert found() == whole and len(whole) >= 60


def test_crowded_block_compares_few_texts(spark):
    """3,000 by 3,000 listings at one address with one common name: the score bound leaves few descriptions to compare."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(300)]

    def side(n):
        terms = lambda k: np.array([hash(w) for w in rng.choice(words, k)])
        kinds = [terms(2) for _ in range(5)]
        pick = lambda pool: [pool[i] for i in rng.integers(0, len(pool), n)]
        return {
            "lat": np.full(n, 45.0), "lon": np.full(n, 7.0), "property_name": [np.array([1, 2])] * n, "location_display": pick(kinds[:3]),
            "property_description": [terms(20) for _ in range(n)], "other_policy": pick([None, *kinds[:2]]), "property_type": pick(kinds),
            "bedroom_count": rng.integers(0, 5, n).astype(float), "bathroom_count": rng.integers(0, 3, n).astype(float),
        }

    rng2 = np.random.default_rng(9)
    left, right = side(3000), side(3000)
    for i in rng2.integers(0, 3000, 200):
        for c in left:
            right[c][i] = left[c][i]
    i, j, scores, compared = duplicates.tile_pairs(left, right, duplicates.FIELD_WEIGHTS, 100, 0.75, True)
    assert compared < 0.05 * 3000 * 3000
    overall = sum(scores[f] * w for f, w in duplicates.FIELD_WEIGHTS.items())
    found = {(a, b) for a, b, s in zip(i.tolist(), j.tolist(), overall) if round(s, 4) >= 0.75}

    def cosine(a, b):
        if a is None or b is None:
            return 0.0
        x, y = Counter(a.tolist()), Counter(b.tolist())
        return sum(x[w] * y[w] for w in x) / math.sqrt(sum(n * n for n in x.values()) * sum(n * n for n in y.values()))

    for a in range(0, 3000, 100):
        for b in range(3000):
            plain = sum(w * (float(left[f][a] == right[f][b]) if f in duplicates.NUMERIC_FIELDS else cosine(left[f][a], right[f][b])) for f, w in duplicates.FIELD_WEIGHTS.items())
            assert ((a, b) in found) == (round(plain, 4) >= 0.75)
    assert len(found) >= 150


def test_duplicates_with_model_vectors(spark):
    row = ("1", None, "POINT (20 10)", "Villa", "House", "Here", "By the sea", "", 2, None)
    other = ("2", None, '{"lat": 10.0005, "lon": 20}', "Casa", "House", "Here", "At the ocean", "", 2, None)
    far = ("3", None, "POINT (20 10.01)", "Villa", "House", "Here", "By the sea", "", 2, 1)
    vectors = spark.createDataFrame(
        [("Villa", [1.0, 0.0]), ("Casa", [1.0, 0.1]), ("By the sea", [0.0, 1.0]), ("At the ocean", [0.0, 2.0]), ("House", [1.0, 1.0]), ("Here", [1.0, 1.0])],
        "text string, vector array<double>",
    )
    found = duplicates.best_first(
        duplicates.find_duplicates(spark.createDataFrame([row], FIELDS), spark.createDataFrame([other, far], FIELDS), threshold=0.7, text_vectors=vectors)
    ).collect()
    assert [(r["source_id"], r["candidate_id"], r["distance_m"]) for r in found] == [("1", "2", 55.6)]
    scores = found[0]["scores"]
    assert (scores["other_policy"], scores["bathroom_count"], scores["bedroom_count"]) == (0.0, 0.0, 1.0)
    assert scores["overall_score"] == pytest.approx(0.25 / math.sqrt(1.01) + 0.25 + 0.1 + 0.1 + 0.1, abs=1e-4)


def test_best_images(spark):
    rows = [("l", f"u{i}", a, {"bedroom": 0.2, "house": b}) for i, (a, b) in enumerate([(0.5, 0.9), (0.91234, 0.1), (None, 0.5), (0.5, 0.2), (0.1, 0.1), (0.3, 0.1)])]
    scores = spark.createDataFrame(rows, "listing_id string, url string, aesthetic double, label_scores map<string,double>")
    best = best_images(image_analysis(scores))
    assert [tuple(r) for r in best.orderBy("rank").collect()] == [
        ("l", "u1", 9.12, "bedroom", 0.2, 1), ("l", "u0", 5.0, "house", 0.9, 2), ("l", "u3", 5.0, "bedroom", 0.2, 3), ("l", "u5", 3.0, "bedroom", 0.2, 4)]
    ranked = ranked_images(best).first()
    assert ranked["ranked_image"] == "u1" and ranked["ranked_images"]["Images"] == ["u1", "u0", "u3", "u5"]


def test_text_vectors(spark):
    texts = spark.createDataFrame([("sea house",), ("sea hut",), ("forest",)], "text string")
    for row in tfidf_vectors(texts, 64).collect():
        assert len(row["vector"]) == 64 and np.linalg.norm(row["vector"]) == pytest.approx(1, abs=1e-5)
    lengths = model_vectors(texts, lambda: lambda batch: [[float(len(t))] for t in batch])
    assert {r["text"]: r["vector"] for r in lengths.collect()} == {"sea house": [9.0], "sea hut": [7.0], "forest": [6.0]}


def test_duplicates_of_table_and_partner_file(spark, tmp_path):
    text = {"property_type": "Loft", "location_display": "Pier 3", "property_description": "A bright loft by the water", "other_policy": "Quiet"}
    own = [("BC-1", "Quay Loft", 2, "SRID=4326;POINT (2.0 41.0)"), ("BC-2", "Far Hut", 2, "SRID=4326;POINT (3.0 41.0)")]
    rows = spark.createDataFrame([{"external_id": i, "property_name": n, "bedroom_count": b, "bathroom_count": 1, "latlon": p, **text} for i, n, b, p in own])
    partner = [
        {"external_id": f"V-{k}", "property_name": name, "bedroom_count": bedrooms, "bathroom_count": 1, "latlon": {"lat": 41.0003, "lon": 2.0}, **text}
        for k, name, bedrooms in ((1, "Quay Loft", 3), (2, "Quay Loft", 2), (3, "Other name", 7))
    ]
    (tmp_path / "p.json").write_text(json.dumps({"data": partner}))
    found = partner_duplicates(spark, evolve(rows, LISTING_SCHEMA), f"{tmp_path}/p.json").collect()
    assert [(r["source_id"], r["candidate_id"], r["distance_m"]) for r in found][:2] == [("BC-1", "V-2", 33.4), ("BC-1", "V-1", 33.4)]
    ranked = ranked_partner_duplicates(spark, evolve(rows, LISTING_SCHEMA), f"{tmp_path}/p.json")
    assert [(r["source_id"], r["candidate_id"]) for r in ranked.orderBy("rank").collect()] == [(r["source_id"], r["candidate_id"]) for r in found]
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, len(found) + 1))
    scores = [r["scores"]["overall_score"] for r in found]
    assert scores == sorted(scores, reverse=True) and scores[0] == 1.0 and all(r["source_id"] == "BC-1" for r in found)
