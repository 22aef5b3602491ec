"""Byte-level BPE: encoding by batched merge rounds in numpy, decoding by a table of byte strings.

The vocabulary file (a parameter) gives ids, merges and the added tokens. A text is cut at added tokens and then by
the pre-tokenizer's pattern; a worker encodes each distinct piece once. One merge round treats all pieces together:
their symbols lie in one flat array, the rank of every adjacent pair is found by binary search in the sorted pair
keys, each piece merges all places of its lowest-ranked pair, and pieces without a pair leave the array.

Style: Arrow batches in the tasks; there is no shuffle, so a lost executor repeats its own input splits only.

Defined results: a NULL text is encoded as the empty one, to no ids. NULL ids decode to the empty text; bytes that
are not UTF-8 decode to replacement characters. Ids outside the vocabulary are an error. Repeated rows are encoded
alike. Columns of the input are kept unless they bear the name of the result.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodgeframe.llm.pieces import PieceStore, groups, in_small_batches

# Fixed value: the pattern of the byte-level pre-tokenizer, which its vocabulary file names but does not hold.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = np.iinfo(np.int64).max
SYMBOLS_AT_ONCE = 2_000_000


def byte_letters() -> list[str]:
    """The character that stands for each byte in a vocabulary: itself where it is visible, else one from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: i for i, c in enumerate(letters)}
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pattern = regex.compile(PATTERN)
        self.store = PieceStore(self.encode_pieces)

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text in order; added tokens are pieces of their own."""
        if self.cut is None or not any(t in text for t in self.added):
            return self.pattern.findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.added else self.pattern.findall(part)
        return out

    def merge_rounds(self, symbols: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge until no piece has a known pair. ``piece`` is the ascending piece number of each symbol."""
        done_symbols, done_pieces = [], []
        while len(symbols):
            key = symbols[:-1] * self.size + symbols[1:]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[place] == key) & (piece[1:] == piece[:-1])
            rank = np.append(np.where(known, self.ranks[place], NO_RANK), NO_RANK)
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
            ended = lowest == NO_RANK
            done_symbols.append(symbols[ended])
            done_pieces.append(piece[ended])
            at = np.flatnonzero((rank == lowest) & ~ended)
            # In a run of equal symbols pairs overlap: every other one from the left merges.
            begins = np.append(True, np.diff(at) != 1) if len(at) else np.zeros(0, bool)
            within = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            at = at[within % 2 == 0]
            symbols = symbols.copy()
            symbols[at] = self.merged[place[at]]
            stays = ~ended
            stays[at + 1] = False
            symbols, piece = symbols[stays], piece[stays]
        if not done_pieces:
            return symbols, piece
        symbols, piece = np.concatenate(done_symbols), np.concatenate(done_pieces)
        order = np.argsort(piece, kind="stable")
        return symbols[order], piece[order]

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the pieces and the number of ids of each."""
        flat, counts = [], []
        begin = 0
        while begin < len(pieces):
            raw: list[bytes] = []
            size = 0
            for text in pieces[begin:]:
                if raw and size + len(text) > SYMBOLS_AT_ONCE:
                    break
                raw.append(b"" if text in self.added else text.encode("utf-8", "surrogatepass"))
                size += len(raw[-1])
            lengths = np.fromiter(map(len, raw), np.int64, len(raw))
            symbols = self.first[np.frombuffer(b"".join(raw), np.uint8)]
            ids, piece = self.merge_rounds(symbols, np.repeat(np.arange(len(raw)), lengths))
            count = np.bincount(piece, minlength=len(raw))
            special = [(i, self.added[p]) for i, p in enumerate(pieces[begin : begin + len(raw)]) if p in self.added]
            if special:
                where = np.cumsum(count)[[i for i, _ in special]]
                ids = np.insert(ids, where, [t for _, t in special])
                count[[i for i, _ in special]] = 1
            flat.append(ids)
            counts.append(count)
            begin += len(raw)
        return np.concatenate(flat), np.concatenate(counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the number of ids of each."""
        cut = [self.pieces(t) for t in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        return self.store.gather(self.store.codes(pa.array(list(chain.from_iterable(cut)), pa.string())), sizes)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@functools.cache
def load(path: str) -> Bpe:
    """One encoder for each worker process and file."""
    return Bpe(path)


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    rest = df.drop(name)
    return rest, T.StructType([*rest.schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text. ``vocabulary`` is a file that every executor can open."""
    kept, schema = _with_column(docs, ids, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for first, last in groups(map(len, texts)):
                flat, counts = bpe.encode(texts[first:last])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, ids])

    return in_small_batches(kept).mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``tokens`` with the text of every whole list of ids, added tokens included."""
    kept, schema = _with_column(tokens, text, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            lists = batch.column(ids)
            edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            texts = [bpe.decode(flat[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return in_small_batches(kept).mapInArrow(run, schema)
