"""Prefix tries against plain Python, contraction of deep and bushy trees, conversations across chunks and ranges."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import contraction, hot, prefix_trie, queries


def plain_trie(conversations):
    """Nodes of (id -> list of (role, text)) by walking every prefix."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    out = []
    sums = {}
    for k in sorted(members, key=len, reverse=True):
        own = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        below = [sums[c] for c in children[k]]
        sums[k] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
        digest = hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()
        parent = min(members[k[:-1]]) if k else None
        out.append((min(members[k]), len(k), parent, len(members[k]), len(children[k]), *sums[k], digest))
    return Counter(out)


def ordered(rows):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            held[c].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest(), text))
    return {c: [(t[2], t[4]) for t in sorted(v)] for c, v in held.items()}


def rebuilt(rows):
    own = ordered(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        group = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(group, [])[:h] + turns[h:]
    return out


def conversations(seed, count):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-12, count), 100_000, 9_999]:
        if rng.random() < 0.15:
            continue
        for turn in range(rng.randint(1, 12)):
            rows.append((c, None if rng.random() < 0.05 else rng.randint(0, 12), rng.choice(["user", "assistant", None]), rng.choice(["hi", "hé", "", None, "ok"])))
    rows += [(None, 0, "user", "nobody")] + rows[:5]
    rows += [(c, t, "user", "same") for c in range(500, 560) for t in range(3)]
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def nodes(frame):
    assert frame.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r) for r in frame.collect())


def test_rebuilt_conversations_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    monkeypatch.setattr(hot, "HOT_ROWS", 20)
    rows = conversations(1, 60)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("clash")).withColumn("position", F.lit(0)).repartition(5)
    turns = prefix_trie.cut_lineage(prefix_trie.numbered(frame))
    assert nodes(prefix_trie.trie(*queries.shared_openings(turns))) == plain_trie(rebuilt(rows))


def test_one_long_conversation(spark, monkeypatch):
    """A conversation that fills several ranges and chunks, and copies of it."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    rows = [(c, t, "user", str(t // 2)) for c in range(3) for t in range(60)] + [(9, 0, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    turns = prefix_trie.cut_lineage(prefix_trie.numbered(frame))
    convs = turns.select("conv").distinct()
    assert sorted((r["conv"], r["position"]) for r in turns.collect()) == sorted((c, t + 1) for c, t, _, _ in rows)
    assert nodes(prefix_trie.trie(turns, convs)) == plain_trie(ordered(rows))


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    turns = prefix_trie.numbered(none)
    assert prefix_trie.trie(turns, turns.select("conv").distinct()).collect() == []


def plain_sums(parents, values):
    children = defaultdict(list)
    for n, p in parents.items():
        children[p].append(n)
    order, stack = [], list(children[None])
    while stack:
        n = stack.pop()
        order.append(n)
        stack += children[n]
    out = dict(values)
    for n in reversed(order):
        out[n] += sum(out[c] for c in children[n])
    return out


@pytest.mark.parametrize("shape", ["star", "random", "caterpillar", "forest"])
def test_subtree_sums(spark, shape):
    rng = random.Random(shape)
    n = 120
    above = {
        "star": lambda i: 0, "random": lambda i: rng.randrange(i),
        "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2), "forest": lambda i: None if i % 40 == 0 else rng.randrange(i - i % 40, i),
    }[shape]
    parents = {0: None} | {i: above(i) for i in range(1, n)}
    values = {i: rng.randint(-5, 5) for i in range(n)}
    frame = spark.createDataFrame([(i, p, values[i], 1) for i, p in parents.items()], "node int, parent int, v bigint, one bigint").repartition(4)
    found = {r["node"]: (r["v"], r["one"]) for r in contraction.subtree_sums(frame, ["v", "one"]).collect()}
    v, one = plain_sums(parents, values), plain_sums(parents, dict.fromkeys(parents, 1))
    assert found == {i: (v[i], one[i]) for i in parents}


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    calls = []
    cut = contraction.cut_lineage
    monkeypatch.setattr(contraction, "cut_lineage", lambda df: calls.append(1) or cut(df))
    chain = spark.range(200).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(1).cast("bigint").alias("v"))
    assert contraction.subtree_sums(chain, ["v"]).where("v != 200 - node").count() == 0
    assert len(calls) <= 60
    assert contraction.subtree_sums(chain.limit(0), ["v"]).collect() == []
