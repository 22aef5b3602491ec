"""Prefix trie of conversations: one node for every distinct sequence of first turns, with sums over subtrees.

A turn's name is the hash of its role and text. The name of a node is two 64-bit words: exclusive ors over hashes of
each of its turns together with the turn's position, so that two sequences have one name only if they hold the same turns
at the same places, and so that names of all prefixes are running sums. Those are taken in pieces of ``CHUNK`` turns
and then over the pieces, and positions over ranges of sorted turns and then over the ranges: no task holds a conversation.
The parent of a node is its name without the last turn. Nodes are counted by name with a combine before the shuffle,
however many conversations share one; sums over subtrees come from parallel tree contraction (``contraction``).

``numbered`` puts the turns of each conversation in order, ``trie`` makes the nodes and ``ends_digest`` the digest of
the conversations that end at each node: ids are joined in runs of ``IDS`` by their value, and the runs of one node are
hashed as a stream, which a sequential hash forces upon one task, but row by row.

Defined results: rows with a NULL conversation take no part; a NULL role or text is empty; NULL turns come first, equal
turns are ordered by role and then by the MD5 of the text; repeated rows are turns of their own. Only the named columns
are read, so further columns cannot clash. Without conversations there are no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgeframe.llm.contraction import subtree_sums
from lodgeframe.llm.hot import join_hot
from lodgeframe.llm.pieces import in_small_batches
from lodgeframe.session import cut_lineage

CHUNK = 1_024
IDS = 4_096


def numbered(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, position, turn_name, bytes): the turns of every conversation, numbered from 1 in order."""
    roles, texts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), roles.alias("role"),
        F.unhex(F.md5(texts)).alias("name"), F.octet_length(texts).cast("bigint").alias("bytes"),
    )
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("name")]
    # Ranges are sampled, so they are kept; a conversation longer than a range goes on in the next one.
    ranged = cut_lineage(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("conv", "range")
    own = ranged.withColumn("own", F.row_number().over(inside.orderBy(F.asc_nulls_first("turn"), "role", "name")))
    sizes = ranged.groupBy("conv", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations that cross a range have rows here: at most one for each end of a range.
    crossing = sizes.withColumn("before", F.sum("n").over(before)).where(F.col("before").isNotNull()).select("conv", "range", "before")
    placed = own.join(F.broadcast(crossing), ["conv", "range"], "left")
    name = F.unhex(F.md5(F.concat(F.col("role").cast("binary"), F.unhex(F.lit("00")), F.col("name"))))
    return placed.select("conv", (F.col("own") + F.coalesce("before", F.lit(0))).cast("bigint").alias("position"), name.alias("turn_name"), "bytes")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, position, bytes, node, parent): for each turn the names of the prefixes that end with it and before it."""
    word = lambda seed: F.xxhash64(F.lit(seed), "position", "turn_name", F.lit(seed))
    words = turns.withColumns({"a": word(1), "b": word(2), "chunk": F.floor((F.col("position") - 1) / CHUNK)})
    inside = Window.partitionBy("conv", "chunk").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    run = words.withColumns({"pa": F.bit_xor("a").over(inside), "pb": F.bit_xor("b").over(inside)})
    chunks = words.groupBy("conv", "chunk").agg(F.bit_xor("a").alias("ca"), F.bit_xor("b").alias("cb"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select("conv", "chunk", F.bit_xor("ca").over(earlier).alias("ca"), F.bit_xor("cb").over(earlier).alias("cb"))
    both = run.join(before, ["conv", "chunk"])
    node = [F.col(f"p{x}").bitwiseXOR(F.coalesce(f"c{x}", F.lit(0).cast("bigint"))) for x in "ab"]
    named = both.select("conv", "position", "bytes", "a", "b", node[0].alias("na"), node[1].alias("nb"))
    return named.select(
        "conv", "position", "bytes", F.struct(F.col("na").alias("a"), F.col("nb").alias("b")).alias("node"),
        F.struct(F.col("na").bitwiseXOR(F.col("a")).alias("a"), F.col("nb").bitwiseXOR(F.col("b")).alias("b")).alias("parent"),
    )


def _root():
    return F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (conv, node): SHA-256 of the ids in ascending order, joined by commas."""
    runs = ends.withColumn("run", F.floor(F.col("conv") / IDS)).groupBy("node", "run").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = runs.select(F.col("node.a").alias("a"), F.col("node.b").alias("b"), "run", "ids").repartition("a", "b").sortWithinPartitions("a", "b", "run").drop("run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None

        def out(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["a", "b", "ends_sha256"])

        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if name == (a, b):
                    digest.update(b"," + ids.encode())
                else:
                    if name is not None:
                        done.append((*name, digest.hexdigest()))
                    name, digest = (a, b), hashlib.sha256(ids.encode())
            if done:
                yield out(done)
        if name is not None:
            yield out([(*name, digest.hexdigest())])

    made = in_small_batches(ordered).mapInArrow(run, "a bigint, b bigint, ends_sha256 string")
    return made.select(F.struct("a", "b").alias("node"), "ends_sha256")


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` is (conv, position, turn_name, bytes), positions from 1 without gaps; ``conversations`` is (conv), one row
    each, those without turns too. ``n_leaves`` and ``saved_tokens`` are sums over the subtree: nodes without
    children, and (n_convs - 1) times the bytes of the last turn's text.
    """
    prefixes = cut_lineage(_prefixes(turns))
    inner = prefixes.groupBy("node").agg(
        F.min("conv").alias("conv_id"), F.max("position").alias("depth"), F.max("parent").alias("parent"),
        F.max("bytes").alias("bytes"), F.count("*").alias("n_convs"),
    )
    root = conversations.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        _root().alias("node"), "conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("struct<a: bigint, b: bigint>").alias("parent"),
        F.lit(0).cast("bigint").alias("bytes"), "n_convs",
    )
    nodes = cut_lineage(inner.unionByName(root))
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = cut_lineage(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))))
    leaves = F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    sums = subtree_sums(nodes.select("node", "parent", leaves.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])

    last = prefixes.groupBy("conv").agg(F.max(F.struct("position", "node")).alias("last")).select("conv", F.col("last.node").alias("node"))
    turnless = conversations.join(last.select("conv"), "conv", "left_anti").select("conv", _root().alias("node"))
    digests = ends_digest(last.unionByName(turnless))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = join_hot(nodes, parents, "parent", "left")
    whole = named.join(sums, "node").join(digests, "node", "left")
    none = hashlib.sha256(b"").hexdigest()
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )
