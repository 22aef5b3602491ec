"""N-gram Jaccard join: documents whose sets of word n-grams have a Jaccard similarity at or above a threshold.

Texts are lower-cased and split at white space; an n-gram is the hash of n words in a row (a shorter text is one
n-gram). MinHash signatures are cut into bands of ``rows`` values; two texts meet if a band agrees. At similarity s
they miss each other with probability (1 - s ** rows) ** bands, which ``banding`` keeps under ``miss``: for 0.8 and
one in a million, 35 bands of 5; at 0.85 it is one in 400 million. Pairs that meet are verified on their full n-gram sets.

Documents with equal sets form one class before any pair is made, so groups of copies cost one row. Band hashes
alone are shuffled to find shared buckets; sets are made again, for classes in shared buckets only, and verified in
tiles (``links``). A document's links are counted without writing pairs.

Style: Arrow batches in the tasks for n-grams, signatures and tiles; the rest are joins and grouping.

Defined results: NULL texts have no class and no link. Texts without words (the empty one too) equal each other and
nothing else. Rows with equal ids are rows like others; a class is named by its least id that is not NULL. Only the
named columns are read and returned; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.links import grouped, link_in_buckets, shared_buckets
from lodgeframe.llm.pieces import groups, in_small_batches
from lodgeframe.session import broadcast_if_small, cut_lineage

WORDS, THRESHOLD, ROWS, MISS = 5, 0.8, 5, 1e-6
SEED = 7
# Up to so many classes of some 100 bytes, counted first, are sent to the texts; beyond that the texts are shuffled.
BROADCAST_CLASSES = 200_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def banding(threshold: float, rows: int, miss: float) -> int:
    """Bands needed so that a pair at ``threshold`` is missed with a probability of ``miss`` at most."""
    return int(np.ceil(np.log(miss) / np.log1p(-(threshold**rows))))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of products spread over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def ngram_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its n-grams; none for a text without words."""
    cut = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    words, of = cut.flatten(), pc.list_parent_indices(cut)
    filled = pc.not_equal(words, "")
    words, of = words.filter(filled).dictionary_encode(), of.filter(filled).to_numpy()
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w, SEED) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    hashes = distinct[words.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    sizes = np.bincount(of, minlength=len(texts))
    ends = np.cumsum(sizes)
    total = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        total = total * MULTIPLIER + hashes[k : k + len(total)]
    for begin, size in zip(ends - sizes, sizes):
        if size >= n:
            yield np.unique(mixed(total[begin : begin + size - n + 1]))
        elif size:
            one = np.zeros(1, np.uint64)
            for h in hashes[begin : begin + size]:
                one = one * MULTIPLIER + h
            yield mixed(one)
        else:
            yield np.zeros(0, np.uint64)


class Signer:
    """MinHash band hashes of a set."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 32, (bands * rows, 1), np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, (bands * rows, 1), np.uint32)
        self.salt = mixed(np.arange(1, bands + 1, dtype=np.uint64) * MULTIPLIER)

    def buckets(self, grams: np.ndarray) -> np.ndarray:
        low = (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32)
        for begin in range(0, len(low), 1024):
            np.minimum(least, (low[None, begin : begin + 1024] * self.a + self.b).min(1), out=least)
        band = self.salt.copy()
        for column in least.reshape(self.bands, self.rows).T:
            band = mixed(band * MULTIPLIER + column)
        return band.view(np.int64)


def _mapped(df: DataFrame, schema: str, make) -> DataFrame:
    """Rows of ``df`` (key, text, ...) with columns made of the n-gram sets of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, last in groups(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                yield make(batch.slice(first, last - first))

    return in_small_batches(df).mapInArrow(run, schema)


def _classes(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(key, mark, node, size, buckets): the class of each document and the band hashes of its set."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        signer = Signer(bands, rows)
        texts = batch.column("text")
        nodes, sizes, buckets = [], [], []
        for grams, known in zip(ngram_sets(pc.fill_null(texts, ""), words), texts.is_valid().to_pylist()):
            nodes.append(hashlib.md5(grams.tobytes()).digest() if known else None)
            sizes.append(grams.nbytes)
            buckets.append(signer.buckets(grams) if len(grams) else None)
        columns = [batch.column("key"), batch.column("mark"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(buckets, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["key", "mark", "node", "size", "buckets"])

    return _mapped(docs, "key bigint, mark binary, node binary, size bigint, buckets array<bigint>", make)


def _verifier(threshold: float):
    least = Fraction(str(threshold))

    def verify(left: list[bytes], right: list[bytes]) -> np.ndarray:
        sides = [[np.frombuffer(p, np.uint64) for p in side] for side in (left, right)]
        sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in sides]
        both = overlaps(*sides, sizes)
        union = sizes[0][:, None] + sizes[1][None, :] - both
        return both * least.denominator >= union * least.numerator

    return verify


def overlaps(left: list[np.ndarray], right: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one side with all of the other, by products of 0/1 matrices."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left], np.int64)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    found = []
    for side, size in zip((left, right), sizes):
        flat = np.concatenate(side)
        place = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        kept = shared[place] == flat if len(shared) else np.zeros(len(flat), bool)
        found.append((np.repeat(np.arange(len(side)), size)[kept], place[kept]))
    total = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, len(shared), 4096):
        width = min(4096, len(shared) - begin)
        parts = []
        for side, (row, column) in zip((left, right), found):
            part = np.zeros((len(side), width), np.float32)
            inside = (column >= begin) & (column < begin + width)
            part[row[inside], column[inside] - begin] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    return total.astype(np.int64)


def _grouped_classes(docs: DataFrame, key: str, text: str, words: int, threshold: float, rows: int, miss: float) -> tuple[DataFrame, DataFrame]:
    """(key, mark, node, ...) of every document and (node, least, n_links, component) of every class."""
    bands = banding(threshold, rows, miss)
    source = docs.select(F.col(key).cast("bigint").alias("key"), F.unhex(F.md5(text)).alias("mark"), F.col(text).alias("text"))
    found = cut_lineage(_classes(source, words, bands, rows))
    # The example of a class is one document; its set is made again if the class shares a bucket.
    classes = found.where(F.col("node").isNotNull()).groupBy("node")
    classes = classes.agg(
        F.count("*").alias("weight"),
        F.min("key").alias("least"),
        F.min(F.struct("key", "mark")).alias("example"),
        F.first("size").alias("size"),
        F.first("buckets").alias("buckets"),
    )
    classes = cut_lineage(classes)
    shared = cut_lineage(shared_buckets(classes.select(F.explode("buckets").alias("bucket"), "node", "size")))
    wanted = classes.join(shared.select("node").distinct(), "node", "left_semi")
    wanted = broadcast_if_small(wanted.select("node", "weight", F.col("example.key").alias("key_"), F.col("example.mark").alias("mark_")), BROADCAST_CLASSES)
    texts = source.join(wanted, source.key.eqNullSafe(wanted.key_) & (source.mark == wanted.mark_)).select("node", "weight", "text")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [grams.tobytes() for grams in ngram_sets(batch.column("text"), words)]
        return pa.RecordBatch.from_arrays([batch.column("node"), batch.column("weight"), pa.array(sets, pa.binary())], names=["node", "weight", "payload"])

    nodes = _mapped(texts, "node binary, weight bigint, payload binary", make).dropDuplicates(["node"])
    linked = grouped(link_in_buckets(shared, nodes, _verifier(threshold)))
    joined = classes.select("node", "weight", "least").join(linked, "node", "left")
    joined = joined.select("node", "least", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    return found, joined


def join_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """(key, class_id, n_links) of every document: the least key that its links lead to, and its number of links.

    A pair is missed with a probability of ``miss`` at most. A document that has no key in reach has a NULL class.
    """
    found, joined = _grouped_classes(docs, key, text, words, threshold, rows, miss)
    names = joined.groupBy("component").agg(F.min("least").alias("class_id"))
    named = joined.join(names, "component").select("node", "class_id", "n_links")
    every = found.select("key", "node").join(named, "node", "left")
    class_id = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("class_id"))
    return every.select(F.col("key").alias(key), class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """``docs`` with one row of each group: of its least key, then of the least MD5 of the text.

    Rows without a key come after all that have one. Of rows with that key and that text one stays. NULL texts belong
    to no group; all of them stay.
    """
    found, joined = _grouped_classes(docs, key, text, words, threshold, rows, miss)
    # Aggregates alone, so that a class with many rows gathers in no task.
    counted = found.where(F.col("node").isNotNull()).groupBy("node", "key", "mark").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("key").isNull().alias("unkeyed"), "key", "mark", "rows")).alias("first")
    chosen = counted.groupBy("node").agg(first).join(joined.select("node", "component"), "node")
    chosen = chosen.groupBy("component").agg(F.min("first").alias("first"))
    chosen = cut_lineage(chosen.select(F.col("first.key").alias("key_"), F.col("first.mark").alias("mark_"), F.col("first.rows").alias("rows_")))

    def of(marked: DataFrame) -> DataFrame:
        same = docs[key].cast("bigint").eqNullSafe(marked["key_"]) & (F.unhex(F.md5(docs[text])) == marked["mark_"])
        return docs.join(marked, same, "left_semi")

    once = of(chosen.where("rows_ = 1"))
    # Keys that repeat with their text are few; only their rows are compared.
    repeated = of(broadcast_if_small(chosen.where("rows_ > 1"))).dropDuplicates([key, text])
    return once.unionByName(repeated).unionByName(docs.where(docs[text].isNull()))
