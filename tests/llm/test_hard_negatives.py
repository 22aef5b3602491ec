"""Hard negatives against brute force, and the bounds that choose what is scored."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import hard_negatives, hot


def plain(rows, every, scale=256):
    """All rows scored against every anchor, one by one."""
    known = {}
    for key, vector, label in rows:
        if key is not None and vector is not None and label is not None and all(x is not None and math.isfinite(x) for x in vector):
            known[(key, label, tuple(math.floor(x * scale) for x in vector))] = True
    out = []
    for key, label, vector in known:
        if key % every:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, w)), j, m) for j, m, w in known if len(w) == len(vector)]
        for s, j in sorted((s, j) for s, j, m in scored if m == label and j != key)[:5]:
            negatives = sorted((t, i) for t, i, m in scored if m != label and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            out += [(key, j, r, i, -s, -t) for r, (t, i) in enumerate(negatives, 1)]
    return sorted(out)


def vectors(seed, length=8, count=500):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        centre = rng.randrange(length)
        v = [rng.gauss(1 if d == centre else 0, 0.3) for d in range(length)]
        if i % 3 == 0 and rows:
            v = list(rng.choice(rows)[1])
        rows.append((i, v, rng.randrange(4)))
    copies = [0.1] * length
    rows += [(1000 + i, copies, 1) for i in range(200)]
    odd = [(2000, None, 1), (2050, [0.0] * length, 2), (2100, [None] * length, 1), (2150, [float("nan")] * length, 1), (2350, [math.inf] * length, 1)]
    odd += [(None, copies, 1), (2200, copies, None), (2250, [0.5] * 3, 1), (2251, [0.4] * 3, 1), (2252, [0.3] * 3, 2), (2300, [], 1), (2301, [], 2), (2302, [], 1)]
    return rows + odd + rows[:2]


SCHEMA = "vec_id bigint, embedding array<double>, label int"


@pytest.mark.parametrize("block, bands", [(16_384, 1), (40, 5)])
def test_mining_equals_brute_force(spark, monkeypatch, block, bands):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", block)
    monkeypatch.setattr(hard_negatives, "REFERENCES", 4)
    rows = vectors(block)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("zone", F.lit(1)).repartition(5)
    found = hard_negatives.mine(frame, F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 50) != []
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_empty_tables_and_few_rows(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).collect() == []
    alone = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 2)], SCHEMA)
    assert hard_negatives.mine(alone, F.col("vec_id") % 50 == 0).collect() == []


def test_scores_are_exact_integers():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(1 << 40), 1 << 40, (5, 7)), rng.integers(-(1 << 40), 1 << 40, (6, 7))
    whole = np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a], object)
    assert (hard_negatives.integer_scores(a, b) == np.clip(whole, *hard_negatives.LONG).astype(np.int64)).all()
    assert (hard_negatives.integer_scores(a >> 30, b >> 30) == (a >> 30) @ (b >> 30).T).all()


@pytest.mark.parametrize("length", [1, 2, 5, 32])
def test_bounds_hold(length):
    rng = np.random.default_rng(length)
    rows, anchors = (np.floor(256 * rng.standard_normal((300, length)) * rng.choice([0, 0.01, 1, 3], (300, 1))) for _ in range(2))
    references = hard_negatives.References(rows[:50].astype(np.int64).tolist(), 6, 2)
    unit, norms = hard_negatives.units(rows)
    angles = references.angles(unit).astype(np.float32)
    own, own_norms = hard_negatives.units(anchors)
    seen = references.angles(own).astype(np.float32).astype(np.float64)
    low, high = hard_negatives.score_bounds(seen, own_norms, angles, angles, norms, norms)
    scores = anchors @ rows.T
    assert (low <= scores).all() and (scores <= high).all()
    low, high = hard_negatives.score_bounds(seen, own_norms, angles.min(0)[None], angles.max(0)[None], norms.min()[None], norms.max()[None])
    assert (low <= scores.min(1, keepdims=True)).all() and (scores.max(1, keepdims=True) <= high).all()


def test_near_zones_are_skipped():
    """On clustered vectors an anchor that asks for near rows visits few zones."""
    rng = np.random.default_rng(4)
    rows = np.repeat(np.eye(16) * 500, 20, 0) + rng.standard_normal((320, 16)) * 10
    references = hard_negatives.References(rows.astype(np.int64).tolist(), 16, 1)
    unit, norms = hard_negatives.units(rows)
    angles = references.angles(unit)
    zone = references.zones(angles, 16)
    ends = [[f(angles[zone == z], 0) for z in np.unique(zone)] for f in (np.min, np.max)]
    sizes = [[f(norms[zone == z]) for z in np.unique(zone)] for f in (np.min, np.max)]
    low, high = hard_negatives.score_bounds(angles, norms, *map(np.array, ends), *map(np.array, sizes))
    assert (high >= 0.9 * norms[:, None] ** 2).sum(1).mean() < 2


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_dealt_out(spark, monkeypatch, how):
    monkeypatch.setattr(hot, "HOT_ROWS", 10)
    many = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(300)], "a int, k int")
    one = spark.createDataFrame([(k, k * 2) for k in range(0, 200)], "k int, b int")
    order = lambda df: sorted(tuple(r) for r in df.select("a", "k", "b").fillna(-1).collect())
    assert order(hot.join_hot(many, one, "k", how)) == order(many.join(one, "k", how))
