"""Links between records that share a bucket, and the groups that links make.

``link_in_buckets`` verifies every pair of nodes that meet in some bucket, once, and returns for each node the sum of
its links and edges enough to join what hangs together: never the pairs themselves. Nodes that hang together by shared
buckets form a family, and a family is dealt out as tiles: its nodes fall into groups of bounded size and each pair of
groups is one tile, so no task holds a family or a bucket. A family of more than ``FAMILY_PARTS`` groups is dealt out
bucket by bucket in the same way instead, which reads a node once for each of its buckets but compares no strangers.
Buckets with equal members count once. Tasks stream tiles from sorted partitions and keep one tile at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.pieces import in_small_batches
from lodgeframe.session import cut_lineage

GROUP_MEMBERS = 512
GROUP_BYTES = 8 << 20
FAMILY_PARTS = 8

# Of the payloads of a tile's two groups: which pairs are linked, as a matrix.
Verify = Callable[[list[bytes], list[bytes]], np.ndarray]


def _share(left: list[list[int]], right: list[list[int]], below: int | None) -> np.ndarray:
    """Whether each pair shares a bucket (numbered lower than ``below``)."""
    code: dict[int, int] = {}

    def places(own: list[list[int]]) -> tuple[list[int], list[int]]:
        rows, columns = [], []
        for i, buckets in enumerate(own):
            for b in buckets:
                if below is None or b < below:
                    rows.append(i)
                    columns.append(code.setdefault(b, len(code)))
        return rows, columns

    a, b = places(left), places(right)
    if not code:
        return np.zeros((len(left), len(right)), bool)
    shared = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, len(code), 4096):
        sides = []
        for own, (rows, columns) in ((left, a), (right, b)):
            side = np.zeros((len(own), min(4096, len(code) - begin)), np.float32)
            rows, columns = np.array(rows, np.int64), np.array(columns, np.int64) - begin
            inside = (columns >= 0) & (columns < side.shape[1])
            side[rows[inside], columns[inside]] = 1
            sides.append(side)
        shared += sides[0] @ sides[1].T
    return shared > 0


def _roots(links: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links the least place that each place hangs together with."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(1)
        after = np.minimum(label, near)
        after = np.minimum(after, after[after])
        if (after == label).all():
            return label
        label = after


def _tile(rows: list[tuple], verify: Verify) -> list[tuple[bytes, int, bytes]]:
    """(node, sum of the weights it links to, root) of one tile's nodes that have links."""
    tile, family, i, j = rows[0][:4]
    if len(rows) < 2:
        return []
    left = sorted((r for r in rows if r[4] == i), key=lambda r: r[5])
    right = left if i == j else sorted((r for r in rows if r[4] == j), key=lambda r: r[5])
    if not left or not right:
        return []
    own = [r[7] for r in left], [r[7] for r in right]
    # In a family's tile pairs must share a bucket; in a bucket's tile no lower one, or they are verified there.
    linked = _share(*own, None) if family else ~_share(*own, tile)
    if i == j:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return []
    linked &= verify([r[8] for r in left], [r[8] for r in right])
    if not linked.any():
        return []
    nodes = left if i == j else left + right
    if i != j:
        whole = np.zeros((len(nodes), len(nodes)), bool)
        whole[: len(left), len(left) :] = linked
        linked = whole | whole.T
    sums = linked @ np.array([r[6] for r in nodes], np.int64)
    names = [r[5] for r in nodes]
    least = _roots(linked)
    return [(names[k], int(sums[k]), names[least[k]]) for k in np.flatnonzero(sums)]


def _tiles(batches: Iterator[pa.RecordBatch], verify: Verify) -> Iterator[pa.RecordBatch]:
    def out(found: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
        columns = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.binary()))], names=["node", "n", "root"])

    held: list[tuple] = []
    found: list[tuple[bytes, int, bytes]] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("tile", "family", "i", "j", "part", "node", "weight", "own", "payload"))):
            if held and held[0][:4] != row[:4]:
                found += _tile(held, verify)
                held = []
                if len(found) > 10_000:
                    yield out(found)
                    found = []
            held.append(row)
    if held:
        found += _tile(held, verify)
    if found:
        yield out(found)


def _parts(members, size):
    """Groups that keep each within ``GROUP_MEMBERS`` and, by the mean size, ``GROUP_BYTES``."""
    return F.least(F.greatest(F.ceil(members / GROUP_MEMBERS), F.ceil(size / GROUP_BYTES)), members).cast("int")


def shared_buckets(members: DataFrame) -> DataFrame:
    """(bucket, node, size, parts): members of buckets with two nodes or more, one bucket of those with equal members.

    ``members`` is (bucket bigint, node binary, size): the size of a node's payload in a task.
    """
    mark = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"m{seed}") for seed in (1, 2)]
    buckets = members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *mark).where("n > 1")
    one = buckets.groupBy("n", "m1", "m2").agg(F.min("bucket").alias("bucket"), F.max("bytes").alias("bytes"))
    return members.join(one.select("bucket", _parts(F.col("n"), F.col("bytes")).alias("parts")), "bucket")


def _tiled(shared: DataFrame) -> DataFrame:
    """(tile, family, node, parts): in which tiles a node is dealt out."""
    low = shared.groupBy("bucket").agg(F.min("node").alias("low"))
    edges = shared.join(low, "bucket").select(F.col("node").alias("a"), F.col("low").alias("b"))
    families = cut_lineage(connected(edges))
    sized = families.join(shared.groupBy("node").agg(F.max("size").alias("size")), "node")
    parts = sized.groupBy("component").agg(_parts(F.count("*"), F.sum("size")).alias("all"))
    families = families.join(parts, "component")
    small = families.where(F.col("all") <= FAMILY_PARTS).select(
        F.xxhash64("component").alias("tile"), F.lit(True).alias("family"), "node", F.col("all").alias("parts")
    )
    large = families.where(F.col("all") > FAMILY_PARTS).select("node")
    return small.unionByName(shared.join(large, "node").select(F.col("bucket").alias("tile"), F.lit(False).alias("family"), "node", "parts"))


def link_in_buckets(shared: DataFrame, nodes: DataFrame, verify: Verify) -> DataFrame:
    """(node, n, root) from tiles. ``shared`` as above, ``nodes`` is (node, weight bigint, payload binary), one row a node.

    ``n`` sums up the weights of linked nodes found in one tile; a node has a row for each tile with links of it.
    """
    own = shared.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("own"))
    rows = _tiled(shared).join(own.join(nodes, "node"), "node")
    part = F.pmod(F.xxhash64("node", "tile"), F.col("parts")).cast("int")
    rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    ends = F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    keys = ["tile", "family", "i", "j"]
    dealt = rows.select("tile", "family", *ends, "part", "node", "weight", "own", "payload").repartition(*keys).sortWithinPartitions(*keys)
    return in_small_batches(dealt).mapInArrow(lambda batches: _tiles(batches, verify), "node binary, n bigint, root binary")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) hangs together with.

    Alternating large-star and small-star steps; the number of edges never grows, and every round is written to the
    shared checkpoint folder, so that a lost executor costs one round.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    now, state = cut_lineage(now), None
    while True:
        after = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")).first()
        if after == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = after
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(low, "a")
        small = pairs.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = cut_lineage(small.where(F.col("a") != F.col("b")).distinct())


def grouped(found: DataFrame) -> DataFrame:
    """(node, n, component) of all nodes in the rows of ``link_in_buckets``."""
    found = cut_lineage(found)
    sums = found.groupBy("node").agg(F.sum("n").alias("n"))
    return sums.join(connected(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "node", "left").select(
        "node", "n", F.coalesce("component", "node").alias("component")
    )
