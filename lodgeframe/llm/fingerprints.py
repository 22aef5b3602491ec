"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text.

A paragraph is a line; blank lines part sections. Below a paragraph lie its pieces: runs of up to 64 characters that end
with punctuation or there. The hash of a piece is its MD5; the hash of a paragraph, a section and the document is the
MD5 of its children's hashes. Equal roots mean equal texts but for hash collisions, since pieces, line breaks and blank
lines together are the whole text. Where roots differ, only differing branches are followed, so an edit is located by
the sections and paragraphs on its path.

The fingerprint is the tree as text: the root in full, then ``|`` before each section, its hash and ``/`` before each
paragraph, its hash, ``:`` and the hashes of its pieces, all cut to eight digits. ``likeness`` compares two
fingerprints alone: twice the number of pieces in common over the number of both (as bags), 1 if neither has any and 0
for a NULL. Equal sections and paragraphs are taken out whole; pieces are counted only in branches that differ.

``with_next`` pairs each text with the one after it in ascending order of the key, around the end to the first, in one
shuffle: ranges of keys are bounded by keys of the table itself, so the first text of a range, which the range before
needs, is known and copied there.

Defined results: a NULL text is an empty one: one section of one paragraph without pieces. NULL keys come first; rows
with equal keys follow a hash of the text, then the text. Repeated rows stay, and follow one another. A single row is
its own successor; an empty table gives no rows. Only the named columns are read, so further columns cannot clash.
Tasks hold a batch of rows and 64 of its texts as Python strings at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.pieces import in_small_batches

PIECE = r"[^.,;:!?|]{1,64}[.,;:!?|]*|[.,;:!?|]+"
SHOWN = 8
# Keys looked at for each range that is to be bounded.
KEYS_PER_RANGE = 32
# Rows of a batch that are Python texts at a time.
ROWS_AT_ONCE = 64

_PIECE = re.compile(PIECE)


def _hash(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def tree(text: str | None) -> list[list[list[str]]]:
    """Hashes of the pieces of each paragraph of each section."""
    return [[[_hash(p) for p in _PIECE.findall(line)] for line in section.split("\n")] for section in (text or "").split("\n\n")]


def fingerprint(text: str | None) -> str:
    shown, tops = [], []
    for section in tree(text):
        paragraphs = [(_hash("".join(pieces)), pieces) for pieces in section]
        top = _hash("".join(h for h, _ in paragraphs))
        tops.append(top)
        shown.append(top[:SHOWN] + "".join(f"/{h[:SHOWN]}:{''.join(p[:SHOWN] for p in pieces)}" for h, pieces in paragraphs))
    return "|".join([_hash("".join(tops)), *shown])


Branch = tuple[int, int, str, str]


def branches(print_: str) -> list[tuple[str, list[Branch]]]:
    """Sections of a fingerprint: hash and paragraphs, each (section, paragraph, hash, pieces); numbers count from 1."""
    out = []
    for s, section in enumerate(print_.split("|")[1:], 1):
        top, *paragraphs = section.split("/")
        out.append((top, [(s, p, *paragraph.split(":")) for p, paragraph in enumerate(paragraphs, 1)]))
    return out


def _without_common(left: list, right: list, name) -> tuple[list, list]:
    """Both lists without the members that pair up by equal names."""
    common = Counter(map(name, left)) & Counter(map(name, right))
    out = []
    for side in (left, right):
        spare, rest = Counter(common), []
        for x in side:
            if spare[name(x)] > 0:
                spare[name(x)] -= 1
            else:
                rest.append(x)
        out.append(rest)
    return out[0], out[1]


def differing(left: str, right: str) -> tuple[list[Branch], list[Branch]]:
    """The paragraphs of either fingerprint that the other lacks. Branches with equal hashes are not entered."""
    if left.partition("|")[0] == right.partition("|")[0]:
        return [], []
    sections = _without_common(branches(left), branches(right), lambda s: (s[0], tuple(p[3] for p in s[1])))
    paragraphs = [[p for _, own in side for p in own] for side in sections]
    return _without_common(*paragraphs, lambda p: p[2:])


def _pieces(paragraphs: list[Branch]) -> Counter:
    return Counter(p[3][i : i + SHOWN] for p in paragraphs for i in range(0, len(p[3]), SHOWN))


def _count(print_: str) -> int:
    return sum(len(p[3]) // SHOWN for _, own in branches(print_) for p in own)


def compare(left: str | None, right: str | None) -> tuple[float, str | None]:
    """(likeness, the first paragraph of ``right`` that ``left`` lacks, else of ``left``, as ``section.paragraph``)."""
    if left is None or right is None:
        return 0.0, None
    mine, theirs = differing(left, right)
    if not mine and not theirs:
        return 1.0, None
    whole = _count(left) + _count(right)
    a, b = _pieces(mine), _pieces(theirs)
    apart = sum(((a - b) + (b - a)).values())
    first = (theirs or mine)[0]
    return (whole - apart) / whole if whole else 1.0, f"{first[0]}.{first[1]}"


def likeness(left: str | None, right: str | None) -> float:
    return compare(left, right)[0]


def _mapped(rows: DataFrame, run, kinds: dict[str, pa.DataType]) -> DataFrame:
    """``rows`` with further columns: ``run`` makes their values from one row's values."""
    names = rows.columns
    fields = [f"`{c}` {'double' if k == pa.float64() else 'string'}" for c, k in kinds.items()]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), *fields])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                made = [run(dict(zip(names, row))) for row in zip(*(c.to_pylist() for c in part.columns))]
                extra = [pa.array([m[k] for m in made], kinds[k]) for k in made[0]]
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=[*names, *made[0]])

    return in_small_batches(rows).mapInArrow(whole, schema)


def with_fingerprints(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``rows`` with a fingerprint column for each text column in ``texts`` (text column: name of the result).

    Texts seen in the row before are not hashed again, which serves successors that come next.
    """
    columns = list(texts)
    held: dict[str, str] = {}

    def run(row: dict) -> dict:
        now = {}
        for c in columns:
            text = row[c] or ""
            now[text] = held.get(text) or now.get(text) or fingerprint(text)
        held.clear()
        held.update(now)
        return {texts[c]: now[row[c] or ""] for c in columns}

    return _mapped(rows, run, {texts[c]: pa.string() for c in columns})


def with_likeness(rows: DataFrame, left: str, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with the likeness of fingerprint ``left`` to others and where they first differ: names by column."""

    def run(row: dict) -> dict:
        out = {}
        for column, (score, place) in pairs.items():
            out[score], out[place] = compare(row[left], row[column])
        return out

    kinds = {c: k for score, place in pairs.values() for c, k in ((score, pa.float64()), (place, pa.string()))}
    return _mapped(rows, run, kinds)


def _range_number(key: Column, bounds: list, first: int = 0) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``, by halving."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(key < bounds[middle], _range_number(key, bounds[:middle], first)).otherwise(
        _range_number(key, bounds[middle + 1 :], first + middle + 1)
    )


def _place(key, mark) -> Column:
    """Sort value of a row: NULL keys first, then the key, then the mark of the text."""
    return F.struct(key.isNotNull().alias("filled"), F.coalesce(key, F.lit(0)).cast("bigint").alias("key"), mark.alias("mark"))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """(key, text, next_text) of every row, in one shuffle of the texts."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    placed = rows.withColumn("place", _place(F.col("key"), F.xxhash64("text")))
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = placed.agg(F.count("*").alias("n"), F.min("place").alias("least")).first()
    if size["n"] == 0:
        return spark.createDataFrame([], "key bigint, text string, next_text string")
    # A bounded sample of places, taken by a hash; equal rows have equal places and count once.
    every = max(1, size["n"] // (ranges * KEYS_PER_RANGE))
    chosen = placed.where(F.pmod(F.xxhash64("place"), F.lit(every)) == 0).select("place").distinct()
    seen = sorted(tuple(r["place"]) for r in chosen.limit(4 * ranges * KEYS_PER_RANGE).collect())
    bounds = sorted({seen[len(seen) * i // ranges] for i in range(1, ranges)} - {tuple(size["least"])}) if seen else []
    starts = [tuple(size["least"]), *bounds]

    def value(place: tuple) -> Column:
        return F.struct(F.lit(place[0]).alias("filled"), F.lit(place[1]).cast("bigint").alias("key"), F.lit(place[2]).cast("bigint").alias("mark"))

    number = _range_number(F.col("place"), [value(b) for b in bounds])
    ranged = placed.select("key", "text", F.col("place.mark").alias("mark"), number.cast("int").alias("range"), F.lit(0).alias("copied"))
    # The first text of each range, once more at the end of the range before.
    wanted = spark.createDataFrame([(*s, (i - 1) % len(starts)) for i, s in enumerate(starts)], "filled boolean, k bigint, m bigint, to int")
    place = (F.col("place.filled") == F.col("filled")) & (F.col("place.key") == F.col("k")) & (F.col("place.mark") == F.col("m"))
    heads = placed.join(F.broadcast(wanted), place).groupBy("to").agg(F.min("text").alias("text"))
    heads = heads.select(F.lit(None).cast("bigint").alias("key"), "text", F.lit(0).cast("bigint").alias("mark"), F.col("to").alias("range"), F.lit(1).alias("copied"))
    ordered = ranged.unionByName(heads).repartitionById(len(starts), F.col("range")).sortWithinPartitions("range", "copied", F.asc_nulls_first("key"), "mark", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            keys, texts, follow = [], [], []
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "text"))):
                if held is not None:
                    keys.append(held[0])
                    texts.append(held[1])
                    follow.append(row[1])
                held = row
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.string()), pa.array(follow, pa.string())], names=["key", "text", "next_text"])

    return in_small_batches(ordered.select("key", "text")).mapInArrow(run, "key bigint, text string, next_text string")
