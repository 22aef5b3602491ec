"""N-gram join and cap filters against brute force, groups of links, tiles."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import cap_filters, links, ngram_join


def components(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def plain_join(rows):
    """(class, links) of each row, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = None if text is None else text.lower().split()
        sets.append(None if words is None else frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    pairs = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a is not None and b is not None and (a == b or a and b and 10 * len(a & b) >= 8 * len(a | b)):
                pairs.append((j, i))
    count = defaultdict(int)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
    root = components(len(rows), pairs)
    keys = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            keys[root[i]].append(key)
    return [(key, min(keys[root[i]]) if keys[root[i]] else None, count[i]) for i, (key, _) in enumerate(rows)]


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(60)]
    for base in range(8):
        text = rng.choices(words, k=rng.choice([4, 5, 6, 30, 120, 300]))
        for _ in range(rng.randint(2, 12)):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(copy) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, None), (902, ""), (903, " \n"), (904, "One"), (905, "one "), (None, rows[70][1]), (None, "alone here"), (70, rows[70][1])]
    rows += [(906, "long " * 50_000), (907, "long " * 60_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [(512, 8), (3, 8), (3, 1)])
def test_join_equals_brute_force(spark, monkeypatch, limits):
    """With small groups the same rows come from many tiles, of families or of buckets."""
    monkeypatch.setattr(links, "GROUP_MEMBERS", limits[0])
    monkeypatch.setattr(links, "FAMILY_PARTS", limits[1])
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("class_id", F.lit("old")).withColumn("node", F.lit("old"))
    found = ngram_join.join_documents(docs).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, plain_join(rows)))


def test_one_document_of_each_group_stays(spark):
    rows = corpus(6)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("extra", F.lit("kept"))
    kept = ngram_join.keep_one(docs).collect()
    want = {(k, c) for k, c, _ in plain_join(rows) if k is not None and k == c}
    assert {(r["doc_id"], r["doc_id"]) for r in kept if r["doc_id"] is not None} == want
    assert len([r for r in kept if r["doc_id"] is not None]) == len(want) and all(r["extra"] == "kept" for r in kept)
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["alone here"]


def plain_keep(rows):
    """(key, text) of the row that stays for each group, by comparing all pairs; NULL texts all stay."""
    groups = defaultdict(list)
    for i, (root, (key, text)) in enumerate(zip(plain_roots(rows), rows)):
        groups[i if text is None else root].append((key is None, key or 0, hashlib.md5((text or "").encode()).digest(), key, text))
    return sorted(str(min(g, key=lambda r: r[:3])[3:]) for g in groups.values())


def plain_roots(rows):
    """A name of each row's group: the join's, with all rows named by their place."""
    return [c for _, c, _ in plain_join([(i, text) for i, (_, text) in enumerate(rows)])]


@pytest.mark.parametrize("unrelated", [[], [(None, None)], [(None, None), (None, "stands alone"), (None, None)]])
def test_rows_without_a_key_follow_their_group(spark, unrelated):
    """Near copies go whether or not another row has no class."""
    words = [f"w{i}" for i in range(60)]
    near = [" ".join([*words[:i], "changed", *words[i + 1 :]]) for i in (0, 59)]
    others = " ".join(f"v{i}" for i in range(60))
    rows = [(7, " ".join(words)), *[(None, t) for t in near], (None, others), (None, others + " more"), (None, others), *unrelated]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(str(tuple(r)) for r in kept) == plain_keep(rows)
    assert len(kept) == 2 + len(unrelated)


def test_repeated_keys_are_rows_like_others(spark):
    """A key that names one group keeps no row of it in another group, and one row where both are in the same."""
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:-1], "changed"])
    rows = [(3, " ".join(words)), (5, near), (5, "alone here"), (8, "other " * 3), (8, "other " * 3), (9, "a b c d e f g h i j k l"), (9, "a b c d e f g h i j k l m")]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(str(tuple(r)) for r in kept) == plain_keep(rows)
    assert sorted(r["doc_id"] for r in kept) == [3, 5, 8, 9]


def test_kept_rows_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [(None if rng.random() < 0.4 else rng.randrange(40), text) for _, text in corpus(7) if text is None or len(text) < 10_000]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, key_ string")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == plain_keep(rows)


def test_join_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.join_documents(empty).count() == ngram_join.keep_one(empty).count() == 0


def test_bands_keep_misses_rare():
    bands = ngram_join.banding(0.8, 5, 1e-6)
    assert (1 - 0.8**5) ** bands <= 1e-6 < (1 - 0.8**5) ** (bands - 1)


def test_overlaps_by_matrix_equal_sets():
    rng = np.random.default_rng(1)
    sides = [[np.unique(rng.integers(0, 300, rng.integers(0, 200)).astype(np.uint64)) for _ in range(n)] for n in (9, 7)]
    sizes = [np.array([len(s) for s in side]) for side in sides]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sides[1]] for a in sides[0]]
    assert ngram_join.overlaps(*sides, sizes).tolist() == want


def test_connected_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    edges = spark.createDataFrame([(a.to_bytes(4, "big"), b.to_bytes(4, "big")) for a, b in pairs], "a binary, b binary")
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["component"], "big") for r in links.connected(edges).collect()}
    root = components(300, pairs)
    assert got == {x: root[x] for a, b in pairs if a != b for x in (a, b)}


def plain_vectors(rows):
    unit = []
    for _, v, label in rows:
        fit = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        scaled = np.array(v, float) / np.abs(v).max() if fit else None
        unit.append(scaled / np.linalg.norm(scaled) if fit else None)
    pairs = [
        (j, i)
        for i in range(len(rows))
        for j in range(i)
        if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98
    ]
    count = defaultdict(int)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
    root = components(len(rows), pairs)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root[i]] = min(least.get(root[i], r[0]), r[0])
    return [(r[0], count[i], least.get(root[i]), r[0] == least.get(root[i])) for i, r in enumerate(rows)]


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = []
    for c in range(25):
        centre = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 30))):
            v = centre + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.14])
            rows.append((len(rows), [float(np.float32(x)) for x in v], int(rng.integers(0, 2))))
    rows += [(2000, rows[0][1], rows[0][2]), (2001, [2 * x for x in rows[0][1]], rows[0][2]), (2002, rows[0][1], None), (2003, None, 1), (2004, [], 1)]
    rows += [(2005, [0.0] * 64, 1), (2006, [float("nan")] + [1.0] * 63, 1), (2007, [float("inf")] + [1.0] * 63, 1), (2008, [1.0, None], 1)]
    rows += [(2009, [1.0, 2.0], 1), (2010, [1.0, 2.01], 1), (2011, [3.0], 1), (2012, [4.0], 1), (0, rows[0][1], rows[0][2]), (2013, [1e300, 1e300], 0), (2014, [1e-300, 1e-300], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit("old"))
    got = sorted(tuple(r) for r in cap_filters.near_vectors(frame).collect())
    want = sorted(plain_vectors(rows))
    assert [g[0] for g in got] == [w[0] for w in want]
    found, there = sum(g[1] for g in got), sum(w[1] for w in want)
    assert 0.999 * there <= found <= there and there > 1000
    assert sum(g == w for g, w in zip(got, want)) >= 0.99 * len(want)
    assert cap_filters.near_vectors(frame.limit(0)).count() == 0


def test_list_decoding_gives_all_filters():
    code = cap_filters.ProductCode(16, 40, 8, 0)
    x = np.random.default_rng(2).standard_normal((50, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for first, second, filters in zip(*code.products(x), code.decode(x)):
        sums = (first[:, None] + second[None, :]).ravel()
        want = np.flatnonzero(sums >= code.bound)
        assert sorted(filters.tolist()) == (want.tolist() if len(want) else [int(sums.argmax())])
