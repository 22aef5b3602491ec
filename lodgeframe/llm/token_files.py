"""Token files of directly addressable codes: any token of a file is read without decoding the ones before it.

Texts are encoded with the tokenizers library. Ids go in ascending document order into blocks. Within a block they
are cut into 8-bit chunks: level 0 holds the low chunk of every id, level k the k-th chunk of those ids that have
more; a bitmap for each level tells which ids go on, and a directory holds the number of set bits before every
512th place. The i-th id takes level 0 at i and, while its bit is set, the rank of that bit as its place one level
up. Blocks are rows of a Parquet table (shard, block, start, n_tokens, doc_ids, counts, codes), so that Spark's
writer commits them and a lost executor leaves no half-written file.

Documents are range-partitioned by id; equal ids, NULL first, spread by a hash of the text, so one id with a third
of all rows is not one partition. Each task streams its sorted rows into blocks of about ``block_tokens`` ids.

Defined results: a NULL or empty text holds only the end id. Rows with equal ids are ordered by a hash of the text,
then the text; identical rows lie side by side. Columns other than id and text are not written.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm.pieces import PieceStore, groups, in_small_batches, wide_batches

END_ID = 1
BLOCK_TOKENS = 1 << 20
SAMPLE = 512
GROUP_CHARACTERS, MAX_WORDS = 6_000_000, 400_000
# No pattern or normaliser of the word vocabulary reaches across ASCII white space, so a text's ids are those of its
# pieces; nor from Latin letters to a run of ASCII punctuation that ends the piece: the vocabulary splits such a run off
# as one, and no composed character contains it.
WORD_AND_MARKS = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\[-`{-~]*)$"
# Pieces of letters alone are encoded many at once with this digit behind each, which the vocabulary splits off by
# itself and whose id no letters give.
BEHIND, TOGETHER = "0", 64
BLOCKS = "shard int, block int, start bigint, n_tokens bigint, doc_ids array<bigint>, counts array<bigint>, codes binary"


class Dac:
    """Directly addressable codes of one block. Layout: number of ids and levels (two 64-bit integers); for each level
    its length (64 bits), chunks, and, except at the last level, the rank directory (32 bits each) and the bitmap."""

    def __init__(self, data: bytes):
        self.n, levels = struct.unpack_from("<qq", data)
        self.levels = []
        at = 16
        for k in range(levels):
            (n,) = struct.unpack_from("<q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n
            ranks = bits = None
            if k < levels - 1:
                ranks = np.frombuffer(data, "<u4", -(-n // SAMPLE), at)
                at += 4 * len(ranks)
                bits = np.frombuffer(data, np.uint8, -(-n // 8), at)
                at += len(bits)
            self.levels.append((chunks, ranks, bits))

    @staticmethod
    def pack(ids: np.ndarray) -> bytes:
        ids = ids.astype(np.uint32)
        widest = int(ids.max()) if len(ids) else 0
        levels = max(1, -(-widest.bit_length() // 8))
        out = [struct.pack("<qq", len(ids), levels)]
        for k in range(levels):
            out += [struct.pack("<q", len(ids)), (ids & 255).astype(np.uint8).tobytes()]
            ids = ids >> 8
            if k < levels - 1:
                more = ids > 0
                before = np.concatenate([[0], np.cumsum(more)])[:-1:SAMPLE] if len(more) else np.zeros(0)
                out += [before.astype("<u4").tobytes(), np.packbits(more, bitorder="little").tobytes()]
                ids = ids[more]
        return b"".join(out)

    def get(self, i: int) -> int:
        """The i-th id, by rank alone."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for chunks, ranks, bits in self.levels:
            value |= int(chunks[i]) << shift
            shift += 8
            if bits is None or not (bits[i >> 3] >> (i & 7)) & 1:
                return value
            first = i // SAMPLE * SAMPLE
            rest = np.unpackbits(bits[first >> 3 : (i >> 3) + 1], bitorder="little")[: i - first]
            i = int(ranks[first // SAMPLE]) + int(rest.sum())
        return value

    def all(self) -> np.ndarray:
        """Every id of the block."""
        place = np.arange(self.n)
        ids = np.zeros(self.n, np.uint32)
        for k, (chunks, _, bits) in enumerate(self.levels):
            ids[place] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            if bits is not None:
                place = place[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return ids


@functools.cache
def _store(vocabulary: str) -> PieceStore:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    (behind,) = tokenizer.encode(BEHIND, add_special_tokens=False).ids

    def flat_ids(texts: list[str]) -> tuple[np.ndarray, list[int]]:
        flat, counts = [np.zeros(0, np.int32)], []
        for begin in range(0, len(texts), 20_000):
            found = [e.ids for e in tokenizer.encode_batch_fast(texts[begin : begin + 20_000], add_special_tokens=False)]
            counts += map(len, found)
            flat.append(np.fromiter(chain.from_iterable(found), np.int32))
        return np.concatenate(flat), counts

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        letters = np.fromiter(map(str.isalpha, pieces), bool, len(pieces))
        words = list(compress(pieces, letters))
        joined, _ = flat_ids([BEHIND.join([*words[i : i + TOGETHER], ""]) for i in range(0, len(words), TOGETHER)])
        others, sizes = flat_ids(list(compress(pieces, ~letters)))
        ends = np.flatnonzero(joined == behind)
        counts = np.zeros(len(pieces), np.int64)
        counts[letters], counts[~letters] = np.diff(ends, prepend=-1) - 1, sizes
        flat = np.zeros(counts.sum(), np.int32)
        of_words = np.repeat(letters, counts)
        flat[of_words], flat[~of_words] = joined[joined != behind], others
        return flat, counts

    return PieceStore(encode, MAX_WORDS)


def token_ids(texts: pa.Array, store: PieceStore) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the texts and the number of ids of each.

    Pieces between white space are told apart first; those that are a word and marks share the ids of the folded word.
    """
    cut = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    pieces, text_of = cut.flatten(), pc.list_parent_indices(cut)
    filled = pc.not_equal(pieces, "")
    sizes = np.bincount(text_of.filter(filled), minlength=len(texts))
    coded = pieces.filter(filled).dictionary_encode()
    parts = pc.extract_regex(coded.dictionary, WORD_AND_MARKS)
    plain = parts.is_valid()
    words = pc.if_else(plain, pc.utf8_lower(parts.field("word")), coded.dictionary)
    marks = pc.if_else(plain, parts.field("marks"), "")
    both = np.column_stack([store.codes(words), store.codes(marks)])[coded.indices.to_numpy()]
    return store.gather(both.ravel(), 2 * sizes)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every whole text, append the end id, and write blocks in ascending order of ``key`` to ``path``."""
    kept = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = kept.repartitionByRange("key", "h").sortWithinPartitions("key", "h", "text").select("key", "text")
    schema = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
        + [("counts", pa.list_(pa.int64())), ("codes", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, shard = _store(vocabulary), TaskContext.get().partitionId()
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        counts: list[int] = []
        block = start = held = 0

        def full() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            columns = ([shard], [block], [start], [len(flat)], [keys], [counts], [Dac.pack(flat)])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in wide_batches(batches, "text", GROUP_CHARACTERS):
            names, texts = batch.column("key").to_pylist(), batch.column("text")
            for first, last in groups(pc.binary_length(texts).to_numpy(zero_copy_only=False), GROUP_CHARACTERS):
                flat, sizes = token_ids(texts.slice(first, last - first), store)
                for name, found in zip(names[first:last], np.split(flat, np.cumsum(sizes)[:-1])):
                    keys.append(name)
                    ids.append(np.append(found, END_ID))
                    counts.append(len(found) + 1)
                    held += counts[-1]
                    if held >= block_tokens:
                        yield full()
                        block, start, held, keys, ids, counts = block + 1, start + held, 0, [], [], []
        if held:
            yield full()

    in_small_batches(ordered).mapInArrow(run, BLOCKS).write.mode("overwrite").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a token file with ``first``, the number of ids in all blocks before. Shard totals are one row for
    each writing task, a number set by the partitions and not by the data, and so are summed in one window and broadcast."""
    from pyspark.sql import Window

    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return blocks.join(F.broadcast(starts), "shard").withColumn("first", F.col("before") + F.col("start")).drop("before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the codes in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, keys, counts, codes in zip(*(batch.column(c).to_pylist() for c in ("first", "doc_ids", "counts", "codes"))):
                ids = Dac(codes).all().astype("<u4")
                ends = np.cumsum(counts)
                starts = ends - counts
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                columns = [pa.array(c, pa.int64()) for c in (keys, starts + first, counts, crcs)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = read_blocks(spark, path).select("first", "doc_ids", "counts", "codes")
    return blocks.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame, place: str = "position") -> DataFrame:
    """(position, token) of the wanted positions in the whole file; positions outside it have no row.

    A position meets its block through the multiples of ``BLOCK_TOKENS`` that the block touches, and is read by rank.
    """
    blocks = read_blocks(spark, path).select("first", "n_tokens", "codes")
    touched = F.explode(F.sequence(F.floor(F.col("first") / BLOCK_TOKENS), F.floor((F.col("first") + F.col("n_tokens") - 1) / BLOCK_TOKENS)))
    asked = wanted.select(F.col(place).cast("bigint").alias("position")).withColumn("cell", F.floor(F.col("position") / BLOCK_TOKENS))
    within = (F.col("position") >= F.col("first")) & (F.col("position") < F.col("first") + F.col("n_tokens"))
    # Positions find the block's number first; codes are joined once for each block that is asked for.
    owner = asked.join(blocks.select("first", "n_tokens", touched.alias("cell")), "cell").where(within)
    lists = owner.withColumn("slice", F.floor(F.col("position") % 4096)).groupBy("first", "slice").agg(F.collect_list("position").alias("positions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, positions, codes in zip(*(batch.column(c).to_pylist() for c in ("first", "positions", "codes"))):
                dac = Dac(codes)
                found = [dac.get(p - first) for p in positions]
                yield pa.RecordBatch.from_arrays([pa.array(positions, pa.int64()), pa.array(found, pa.int64())], names=["position", "token"])

    return lists.join(blocks.select("first", "codes"), "first").select("first", "positions", "codes").mapInArrow(run, "position bigint, token bigint")
