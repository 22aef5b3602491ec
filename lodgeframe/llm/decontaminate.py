"""Benchmark decontamination: benchmark items found in documents within an edit budget.

An item of m characters may differ by k = rate * m edits. It is split into k + 1 pieces; by the pigeonhole principle
one of them occurs unchanged. One Aho-Corasick automaton finds the piece hits of all items in a text. Above the
pieces stands a binary tree whose nodes share out the budget the same way (a node with budget e over two with e1 and
e2, e1 + e2 = e - 1: one of them keeps its share), so a hit is verified from its piece upwards, by Myers'
bit-parallel distance, and a chance hit ends at a node of two pieces.

Texts and items are compared in lower case with single spaces; spans are code points of the text as it was.

Items travel to the tasks in chunks of about ``CHUNK_CHARACTERS``, counted before; a larger benchmark takes several
passes over the documents. Documents are scanned whole, in one pass of Arrow batches without a shuffle.

Defined results: NULL and empty texts and items match nothing; items shorter than ``EXACT_BELOW`` characters must
occur unchanged, between word boundaries. Items equal after folding are reported each; repeated rows of the
benchmark once; repeated documents each. Columns of the input are kept unless they bear the name of the result.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe.llm.pieces import in_small_batches

EDIT_RATE = 0.1
EXACT_BELOW = 25
CHUNK_CHARACTERS = 1_000_000

MATCH = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "start", "end", "distance")]))
ARROW_MATCH = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "distance")]))


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def original_places(text: str) -> list[int]:
    """For every character of ``folded(text)`` its place in ``text``, and the end of the last one."""
    places: list[int] = []
    end = 0
    for word in re.finditer(r"\S+", text):
        if places:
            places.append(end)
        if len(word[0].lower()) == len(word[0]):
            places += range(word.start(), word.end())
        else:
            places += [word.start() + i for i, c in enumerate(word[0]) for _ in c.lower()]
        end = word.end()
    return [*places, end]


def inside_word(text: str, at: int) -> bool:
    """Whether the characters before and after place ``at`` belong to one word: letters, digits, marks or underscores."""
    return 0 < at < len(text) and all(c.isalnum() or c == "_" or unicodedata.category(c)[0] == "M" for c in text[at - 1 : at + 1])


def occurrence_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return dict(masks)


def nearest(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to a part of ``text`` and the end of the first such part (Myers)."""
    ones, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = ones, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        rise = down | (~(horizontal | up) & ones)
        fall = up & horizontal
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
        rise, fall = (rise << 1) & ones, (fall << 1) & ones
        up, down = fall | (~(vertical | rise) & ones), rise & vertical
        if score < best:
            best, end = score, j
    return best, end


@dataclass(frozen=True)
class Node:
    start: int
    end: int
    budget: int
    parent: int


class Item:
    """An item's tree of nodes; ``leaves`` are the pieces."""

    def __init__(self, text: str, ids: list[int], rate: float):
        self.text, self.ids = text, ids
        self.budget = int(rate * len(text)) if len(text) >= EXACT_BELOW else 0
        self.nodes: list[Node] = []
        self.leaves: list[int] = []
        edges = [len(text) * i // (self.budget + 1) for i in range(self.budget + 2)]
        waiting = [(0, self.budget + 1, -1)]
        while waiting:
            first, last, parent = waiting.pop()
            self.nodes.append(Node(edges[first], edges[last], last - first - 1, parent))
            if last - first == 1:
                self.leaves.append(len(self.nodes) - 1)
            else:
                middle = first + (last - first) // 2
                waiting += [(first, middle, len(self.nodes) - 1), (middle, last, len(self.nodes) - 1)]

    @functools.cache  # noqa: B019 - items live as long as their matcher
    def masks(self, node: int) -> dict[str, int]:
        return occurrence_masks(self.text[self.nodes[node].start : self.nodes[node].end])

    @functools.cached_property
    def backward(self) -> dict[str, int]:
        return occurrence_masks(self.text[::-1])


class Matcher:
    """Piece hits and their verification for one chunk of items."""

    def __init__(self, items: list[tuple[str, list[int]]], rate: float):
        self.items = [Item(text, ids, rate) for text, ids in items]
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, item in enumerate(self.items):
            for leaf in item.leaves:
                pieces[item.text[item.nodes[leaf].start : item.nodes[leaf].end]].append((i, leaf))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, distance) in folded code points, one for each part of ``text`` that resembles an item."""
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        failed: set[tuple[int, int, int]] = set()
        if not self.items:
            return []
        for last, (length, owners) in self.automaton.iter(text):
            for i, leaf in owners:
                item = self.items[i]
                # Where the item would begin if no edit came before this piece.
                begin = last + 1 - length - item.nodes[leaf].start
                if any(start - item.budget <= begin <= start + item.budget for start, _, _ in found[i]):
                    continue
                hit = self._verified(text, i, item, leaf, begin, failed)
                if hit and hit not in found[i]:
                    found[i].append(hit)
        return [(i, *hit) for i, hits in found.items() for hit in hits]

    def _verified(self, text: str, i: int, item: Item, leaf: int, begin: int, failed: set) -> tuple[int, int, int] | None:
        m = len(item.text)
        if begin >= 0 and text.startswith(item.text, begin):
            whole = item.budget or not (inside_word(text, begin) or inside_word(text, begin + m))
            return (begin, begin + m, 0) if whole else None
        if not item.budget:
            return None
        at = item.nodes[leaf].parent
        while at >= 0:
            node = item.nodes[at]
            if (i, at, begin) in failed:
                return None
            low = max(0, begin + node.start - node.budget)
            window = text[low : begin + node.end + node.budget]
            distance, end = nearest(item.masks(at), node.end - node.start, window)
            if distance > node.budget:
                failed.add((i, at, begin))
                return None
            if node.parent < 0:
                return self._placed(text, item, low, low + end)
            at = node.parent
        return None


    @staticmethod
    def _placed(text: str, item: Item, low: int, end: int) -> tuple[int, int, int]:
        """The best match around one that ends at ``end``: the hit that led there may have been a chance one beside it."""
        m = len(item.text)
        # No further to the right, or a whole copy that follows would draw the match onto itself.
        low, high = max(0, min(low, end - m - 2 * item.budget)), end + item.budget
        distance, last = nearest(item.masks(0), m, text[low:high])
        _, length = nearest(item.backward, m, text[low : low + last][::-1])
        return low + last - length, low + last, distance


def _chunks(items: DataFrame, key: str, text: str, characters: int) -> Iterator[list[tuple[str, list[int]]]]:
    """Folded items with their ids, about ``characters`` at a time."""
    known = items.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).distinct()
    total = known.agg(F.sum(F.length("text") + 1).alias("n")).first()["n"] or 0
    n = max(1, -(-total // characters))
    for i in range(n):
        grouped: dict[str, list[int]] = defaultdict(list)
        for r in known.where(F.pmod(F.xxhash64("key", "text"), F.lit(n)) == i).toLocalIterator():
            if item := folded(r["text"]):
                grouped[item].append(r["key"])
        yield [(t, sorted(ids)) for t, ids in sorted(grouped.items())]


def _pass(docs: DataFrame, chunk: list[tuple[str, list[int]]], text: str, column: str, rate: float, only_hits: bool) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, T.StructField(column, MATCH)])
    shared = docs.sparkSession.sparkContext.broadcast(chunk)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate)
        for batch in batches:
            out = []
            for whole in batch.column(text).to_pylist():
                hits = matcher.matches(folded(whole)) if whole else []
                if hits:
                    place = original_places(whole)
                    hits = [(k, place[a], place[b - 1] + 1, d) for i, a, b, d in hits for k in matcher.items[i].ids]
                out.append([dict(zip(("item_id", "start", "end", "distance"), h)) for h in sorted(hits, key=lambda h: (h[1], h[0]))])
            made = pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, ARROW_MATCH)], names=[*batch.schema.names, column])
            yield made.filter(pa.array([bool(x) for x in out], pa.bool_())) if only_hits else made

    return in_small_batches(docs).mapInArrow(run, schema)


def with_matches(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE, matches: str = "matches"
) -> DataFrame:
    """``docs`` with ``matches``: (item_id, start, end, distance) of every part that resembles an item."""
    out = docs.drop(matches)
    parts = []
    for i, chunk in enumerate(_chunks(items, item_key, item_text, CHUNK_CHARACTERS)):
        parts.append(f"_matches_{i}")
        out = _pass(out, chunk, text, parts[-1], rate, False)
    return out.withColumn(matches, F.flatten(F.array(*parts))).drop(*parts)


def find_matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", rate: float = EDIT_RATE) -> DataFrame:
    """(key, item_id, start, end, distance), a row for each match."""
    kept = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    found = [_pass(kept, chunk, "_text", "m", rate, True).select(key, F.explode("m").alias("m")) for chunk in _chunks(items, "item_id", "text", CHUNK_CHARACTERS)]
    return functools.reduce(DataFrame.unionByName, found).select(key, "m.*")
