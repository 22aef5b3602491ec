import math
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe.functions import geo, ids, text, vectors
from lodgeframe.operators import cleaning, documents, sitemap

X = F.col("x")


@pytest.mark.parametrize(
    "html, plain",
    [("<h2>Big</h2>\n <p>house here</p>", "Big house here"), (None, ""), ("  a  b ", "a b"), ("a<b", "a<b"), ("<br/>", "")],
)
def test_html_becomes_plain_text(evaluate, html, plain):
    assert evaluate(text.strip_html(X), row=(html,)) == plain


@pytest.mark.parametrize(
    "name, slug",
    [
        ("Casa Lumen", "casa-lumen"),
        ("Château d'Été & Spa", "chateau-d-ete-spa"),
        ("Straße 5, Ærø", "strasse-5-aero"),
        ("Łódź – Center", "lodz-center"),
        ("1,000 Steps", "1000-steps"),
        ("Αθήνα ΣΠΊΤΙ", "athena-spiti"),
        ("Дом у моря 2", "dom-u-moria-2"),
        ("Подъезд", "podezd"),
        ("  --  ", ""),
        (None, ""),
    ],
)
def test_slug(evaluate, name, slug):
    assert evaluate(text.slugify(X), row=(name,)) == slug


@pytest.mark.parametrize("raw, number", [("3.0", 3), ("3.9", 3), ("-3.9", -3), ("7", 7), ("", None), ("x", None), (None, None), ("1e99", None)])
def test_integers_truncate(evaluate, raw, number):
    assert evaluate(text.to_int(X), row=(raw,)) == number


def test_decimals_that_do_not_fit_are_null(evaluate):
    assert str(evaluate(text.to_decimal(X, 4, 2), row=("8.456",))) == "8.46"
    assert evaluate(text.to_decimal(X, 4, 2), row=("1234.5",)) is None


@pytest.mark.parametrize(
    "lat, lon, point",
    [
        ("32.5128", "45.8185", "SRID=4326;POINT (45.8185 32.5128)"),
        ("1", "2", "SRID=4326;POINT (2.0 1.0)"),
        ("0.0005", "-0.00025", "SRID=4326;POINT (-0.00025 0.0005)"),
        ("north", "2", None),
        (None, "2", None),
        ("NaN", "2", None),
    ],
)
def test_point_text(evaluate, lat, lon, point):
    assert evaluate(geo.point_text(X, F.col("y")), "x string, y string", (lat, lon)) == point


@pytest.mark.parametrize(
    "value, expected",
    [
        ("SRID=4326;POINT (-97.0 27.5)", (27.5, -97.0)),
        ("POINT(2 1)", (1.0, 2.0)),
        ('{"lat": 1, "lon": "2"}', (1.0, 2.0)),
        ('{"latitude": 1, "longitude": 2}', (1.0, 2.0)),
        ('{"coordinates": [2, 1]}', (1.0, 2.0)),
        ('{"coordinates": [2, 1, 0]}', None),
        ("1,2", None),
        (None, None),
    ],
)
def test_points_in_every_shape(evaluate, value, expected):
    got = evaluate(geo.any_point(X), row=(value,))
    assert (tuple(got) if got else None) == expected


def test_distance(evaluate):
    def metres(*p):
        return evaluate(geo.haversine_m(*[F.col(c) for c in "abcd"]), "a double, b double, c double, d double", p)

    assert metres(0.0, 0.0, 1.0, 0.0) == pytest.approx(111_195, abs=1)
    assert metres(10.0, 20.0, 10.0, 20.0) == 0
    assert metres(10.0, 20.0, -30.0, 140.0) == pytest.approx(metres(-30.0, 140.0, 10.0, 20.0))
    assert metres(0.0, 0.0, 0.0, 180.0) == pytest.approx(math.pi * 6_371_000)


@pytest.mark.parametrize("a, b, score", [([1.0, 2.0], [1.0, 2.0], 1), ([1.0, 0.0], [0.0, 1.0], 0), ([1.0, 0.0], [-2.0, 0.0], -1), ([0.0, 0.0], [1.0, 1.0], 0)])
def test_cosine(evaluate, a, b, score):
    assert evaluate(vectors.cosine(X, F.col("y")), "x array<double>, y array<double>", (a, b)) == pytest.approx(score)


@pytest.mark.parametrize("a, b, score", [(1, 1, 1.0), (1, 2, 0.0), (None, 1, 0.0), (None, None, 0.0)])
def test_numbers_match_exactly(evaluate, a, b, score):
    assert evaluate(vectors.numeric_match(X, F.col("y")), "x int, y int", (a, b)) == score


@pytest.mark.parametrize("a, b, score", [(" House", "house ", 1.0), ("House", "Flat", 0.0), ("", "", 0.0), (None, "x", 0.0)])
def test_categories_match_without_case(evaluate, a, b, score):
    assert evaluate(vectors.categorical_match(X, F.col("y")), "x string, y string", (a, b)) == score


def test_point_id_is_the_name_based_uuid(spark):
    names = ["BC-1812", "", "Zürich ☃", *[f"BC-{i}" for i in range(300)]]
    rows = spark.createDataFrame([(n,) for n in names], "x string").select("x", ids.uuid5_dns(X).alias("u")).collect()
    assert {r["x"]: r["u"] for r in rows} == {n: str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names}


@pytest.mark.parametrize("allowed, shown", [("no", "Pets are not allowed"), ("yes", "Pets are allowed"), (None, "Pet policy not specified"), ("?", "Pet policy not specified")])
def test_pets_text(evaluate, allowed, shown):
    assert evaluate(cleaning.pets_policy_text(X), row=(allowed,)) == shown


@pytest.mark.parametrize("age, adults", [(18, True), (21, True), (17, False), (None, False)])
def test_adults_only_from_18(evaluate, age, adults):
    assert evaluate(cleaning.adults_only(X), "x int", (age,)) is adults
    assert evaluate(cleaning.checkin_age_text(X), "x int", (age,)).startswith("Only adults" if adults else "Anyone")


_PHOTOS = "x array<struct<main_photo: string, url: struct<standard: string, thumbnail: string>>>"


@pytest.mark.parametrize(
    "photos, feature, images",
    [
        ([("false", ("a", None)), ("true", ("b", None))], "b", ["a", "b"]),
        ([("false", ("a", None)), (None, ("b", None))], "a", ["a", "b"]),
        ([("true", ("", None)), ("true", ("b", None))], "b", ["b"]),
        ([("true", None)], "", []),
        ([], "", []),
        (None, "", []),
    ],
)
def test_main_photo_else_first(evaluate, photos, feature, images):
    got = cleaning.feature_image_and_images(X)
    assert evaluate(got[0], _PHOTOS, (photos,)) == feature
    assert evaluate(got[1], _PHOTOS, (photos,)) == images


@pytest.mark.parametrize(
    "raw, shown",
    [
        ("2026-07-14T09:12:31Z", "2026-07-14T09:12:31+00:00"),
        (" 2026-07-14 09:12 ", "2026-07-14T09:12:00"),
        ("2026-07-14", "2026-07-14T00:00:00"),
        ("2026-07-14T09:12:31.5-07:00", "2026-07-14T09:12:31.500000-07:00"),
        ("yesterday", "yesterday"),
        ("2026-13-45", "2026-13-45"),
        (None, "2026-01-01T00:00:00"),
    ],
)
def test_lastmod_from_text(evaluate, raw, shown):
    now = F.lit(datetime(2026, 1, 1)).cast("timestamp")
    assert evaluate(sitemap.lastmod(X, T.StringType(), now), row=(raw,)) == shown


def test_lonlat_order(evaluate):
    assert evaluate(documents.lonlat(X), row=("SRID=4326;POINT (45.8185 32.5128)",)) == [45.8185, 32.5128]
    assert evaluate(documents.lonlat(X), row=("nowhere",)) is None
