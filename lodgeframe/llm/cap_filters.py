"""Embedding near-duplicates through spherical-cap filters of a structured product code.

A filter is a direction; a vector passes those whose inner product with it exceeds a bound, a spherical cap. The
directions are a product code: after a random rotation the dimensions form two blocks with ``codewords`` random unit
vectors each, and every pair of codewords is a filter, so codewords ** 2 filters cost only 2 * codewords products.
List decoding gives all filters a vector passes: second-block products are sorted, and for each first codeword those
that bring the sum over the bound are found by binary search. Near vectors share filters; vectors that share one are
compared exactly. Links hold only between equal labels, which are part of the filter's number.

The bound is set so that a vector passes ``passes`` filters of a code on average. Filters of one code that share a
codeword pass together, so two vectors at cosine 0.98 miss each other in one code of 16 passes in some 1.4 % of pairs
(measured); ``codes`` codes of rotations of their own make that one in 300,000. The tests measure recall.

Equal vectors of a label form one class first. Filters are shuffled as numbers; vectors are joined only to classes
that share a filter, and verified in tiles (``links``), which give sums and joining edges, never pairs.

Defined results: a row whose vector is NULL, empty, zero, or holds NULL or non-finite components, or whose label is
NULL, links with nothing and names itself. Vectors of different lengths never link. Rows with equal ids are rows like
others; a component is named by its least id that is not NULL. Only the named columns are read and returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.pieces import in_small_batches
from lodgeframe.llm.links import grouped, link_in_buckets, shared_buckets
from lodgeframe.session import cut_lineage

THRESHOLD, CODEWORDS, PASSES, CODES = 0.98, 1024, 16, 3
SEED = 11
ROWS_AT_ONCE = 512


class ProductCode:
    """The filters of one vector length."""

    def __init__(self, length: int, codewords: int, passes: float, number: int):
        rng = np.random.default_rng([SEED, length, number])
        self.rotation = np.linalg.qr(rng.standard_normal((length, length)))[0]
        self.half = max(1, length // 2)
        self.codes = []
        for width in (self.half, max(1, length - self.half)):
            code = rng.standard_normal((codewords, width))
            self.codes.append(code / np.linalg.norm(code, axis=1, keepdims=True))
        # The share passes / codewords ** 2 of the sums over random directions lies beyond the bound.
        x = rng.standard_normal((64, length))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = self.products(x)
        tops = [np.partition((p[:, None] + q[None, :]).ravel(), -int(4 * passes) - 1)[-int(4 * passes) - 1 :] for p, q in zip(a, b)]
        self.bound = float(np.sort(np.concatenate(tops))[-int(passes * len(x))])

    def products(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = x @ self.rotation
        second = turned[:, self.half :] if turned.shape[1] > self.half else turned[:, :1]
        return turned[:, : self.half] @ self.codes[0].T, second @ self.codes[1].T

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the numbers of all filters that it passes; at least its best one."""
        out = []
        for first, second in zip(*self.products(x)):
            order = np.argsort(-second)
            ranked = -second[order]
            able = np.flatnonzero(first >= self.bound + ranked[0])
            counts = np.searchsorted(ranked, first[able] - self.bound, side="right")
            if not counts.sum():
                able, counts = np.array([first.argmax()]), np.array([1])
            places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            out.append(np.repeat(able, counts) * len(second) + order[places])
        return out


@cache
def _codes(length: int, codewords: int, passes: float, codes: int) -> list[ProductCode]:
    return [ProductCode(length, codewords, passes, i) for i in range(codes)]


def _number(label: bytes, length: int, filters: np.ndarray) -> np.ndarray:
    """Bucket numbers: a hash of label, vector length and filter."""
    base = int.from_bytes(hashlib.blake2b(label + length.to_bytes(4, "little"), digest_size=8).digest(), "little")
    x = filters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(base)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def _filtered(rows: DataFrame, codewords: int, passes: float, codes: int) -> DataFrame:
    """(key, node, buckets, payload): the class of each row, the filters and the unit vector; NULL for unfit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                labels, vectors = part.column("label").to_pylist(), part.column("vector").to_pylist()
                nodes: list = [None] * len(labels)
                buckets: list = [None] * len(labels)
                payloads: list = [None] * len(labels)
                lengths: dict[int, list[int]] = {}
                for i, (label, vector) in enumerate(zip(labels, vectors)):
                    if label is not None and vector and None not in vector:
                        lengths.setdefault(len(vector), []).append(i)
                for length, places in lengths.items():
                    x = np.array([vectors[i] for i in places], np.float64)
                    scale = np.abs(x).max(1)
                    fit = np.isfinite(scale) & (scale > 0)
                    x, places = x[fit] / scale[fit, None], np.array(places)[fit]
                    if not len(places):
                        continue
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    passed = zip(*(code.decode(x) for code in _codes(length, codewords, passes, codes)))
                    for i, unit, filters in zip(places, x, passed):
                        own = labels[i].encode()
                        payloads[i] = unit.tobytes()
                        nodes[i] = hashlib.md5(len(own).to_bytes(4, "little") + own + np.array(vectors[i], np.float64).tobytes()).digest()
                        buckets[i] = np.unique(np.concatenate([_number(own, length, f + k * codewords**2) for k, f in enumerate(filters)]))
                kinds = (pa.binary(), pa.list_(pa.int64()), pa.binary())
                columns = [part.column("key"), *(pa.array(c, k) for c, k in zip((nodes, buckets, payloads), kinds))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "buckets", "payload"])

    return in_small_batches(rows).mapInArrow(run, "key bigint, node binary, buckets array<bigint>, payload binary")


def _verifier(threshold: float):
    def verify(left: list[bytes], right: list[bytes]) -> np.ndarray:
        sides = [[np.frombuffer(p, np.float64) for p in side] for side in (left, right)]
        return np.array(sides[0]) @ np.array(sides[1]).T >= threshold

    return verify


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    codewords: int = CODEWORDS,
    passes: float = PASSES,
    codes: int = CODES,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    rows = vectors.select(
        F.col(key).cast("bigint").alias("key"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    found = cut_lineage(_filtered(rows, codewords, passes, codes))
    fit = found.where(F.col("node").isNotNull())
    classes = cut_lineage(fit.groupBy("node").agg(F.count("*").alias("weight"), F.min("key").alias("least")))
    # Equal vectors have equal filters and payloads: any row of a class speaks for it.
    members = fit.select(F.explode("buckets").alias("bucket"), "node", F.octet_length("payload").cast("bigint").alias("size")).distinct()
    shared = cut_lineage(shared_buckets(members))
    wanted = shared.select("node").distinct()
    nodes = fit.select("node", "payload").join(wanted, "node", "left_semi").groupBy("node").agg(F.min("payload").alias("payload"))
    nodes = nodes.join(classes, "node").select("node", "weight", "payload")
    linked = grouped(link_in_buckets(shared, nodes, _verifier(threshold)))
    joined = classes.join(linked, "node", "left").select(
        "node", "least", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component")
    )
    names = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.join(names, "component").select("node", "component_id", "n_links")
    every = found.select("key", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    out = every.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
