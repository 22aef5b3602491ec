"""Hard negatives by angular triangle filtering.

For each anchor its best rows of the same label are positives; for each positive the best rows of another label whose
score lies in a window relative to the positive's are negatives. A score is the integer inner product of two vectors.

Every vector stores its angles to a few reference directions. By the triangle inequality on the sphere the angle
between two vectors lies between the greatest difference and the least sum of their angles to a reference. The cosines
of these ends, multiplied by the norms and widened for rounding, bound the score. Bounds are used twice. Vectors fall
into zones (nearest reference, band of the angle to it) that hold the least and greatest of each stored angle and of
the norm: an anchor visits only zones whose bounds overlap the scores it asks for. Inside a block of a zone rows are
sorted by the angle to the zone's reference, so that the rows that can matter are one window found by binary search;
only windows get integer scoring, as matrix products of exact integers.

1. Each block scores its own anchors against its rows of the same label: a floor under each anchor's last positive.
2. Anchors visit the other zones that can beat the floor. The best rows of both steps are the positives.
3. Anchors visit the zones that overlap the windows their positives ask for, and take the best rows of other labels.

Rows equal in label and vector are one class with its least ids, all that can be listed, so a large group of copies is
one row and its anchors share their work. Blocks hold at most about ``BLOCK_ROWS`` classes and meet at most about
``TILE_ANCHORS`` anchors at a time. The zones' bounds (``REFERENCES`` x ``BANDS`` rows for each vector length) and the
references, chosen farthest-first in a sample of ``SAMPLE`` classes, are all that travels to every task.

Defined results: rows take no part if id, label or vector is NULL or a component is NULL or not finite. Rows equal in
id, label and vector count once; rows that share an id but differ are different rows. A row is never its own positive.
Vectors of different lengths never meet; empty or zero vectors score 0. Components and scores beyond a long's range
stand at its ends. Fewer rows than asked for give fewer, an anchor without positives or negatives gives none. An empty
table gives no rows. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgeframe.llm.hot import join_hot
from lodgeframe.llm.pieces import in_small_batches
from lodgeframe.session import cut_lineage

SCALE, POSITIVES, NEGATIVES = 256.0, 5, 3
# A negative's score lies between these shares (in hundredths) of the positive's score.
LOWEST, HIGHEST = 50, 95
REFERENCES, BANDS, SAMPLE = 32, 64, 4_096
BLOCK_ROWS, TILE_ANCHORS, ANCHORS_AT_ONCE = 16_384, 16_384, 256
# Angles are stored in single precision; arc cosines near 0 and pi lose half of a double's digits.
SLACK = 1e-6
LONG = (-(1 << 63), (1 << 63) - 1)
FAR = 1 << 40  # zones are numbered length * FAR + place


def spread_references(sample: np.ndarray, count: int) -> np.ndarray:
    """At most ``count`` of the unit vectors in ``sample``, each as far from the chosen ones as can be."""
    chosen = [0]
    best = sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(best.argmin()))
        best = np.maximum(best, sample @ sample[chosen[-1]])
    return sample[chosen]


class References:
    """Reference directions of each vector length in the sample; other lengths have one axis."""

    def __init__(self, vectors: list[list[int]], count: int, bands: int):
        self.bands, self.of = bands, {}
        by_length: dict[int, list[list[int]]] = {}
        for v in vectors:
            by_length.setdefault(len(v), []).append(v)
        for length, group in by_length.items():
            unit = units(np.array(group, np.float64).reshape(len(group), length))[0]
            unit = unit[(unit != 0).any(1)] if length else unit[:0]
            if len(unit):
                self.of[length] = spread_references(unit, count)

    def directions(self, length: int) -> np.ndarray:
        return self.of[length] if length in self.of else np.eye(1, length)

    def angles(self, unit: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(unit @ self.directions(unit.shape[1]).T, -1, 1))

    def zones(self, angles: np.ndarray, length: int) -> np.ndarray:
        nearest = angles.argmin(1)
        band = np.minimum(angles[np.arange(len(angles)), nearest] * (self.bands / np.pi), self.bands - 1).astype(np.int64)
        return length * FAR + nearest * self.bands + band

    def reference(self, zone: int) -> int:
        return zone % FAR // self.bands


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero ones stay zero) and norms."""
    norms = np.linalg.norm(vectors, axis=1)
    return np.divide(vectors, norms[:, None], out=np.zeros_like(vectors), where=norms[:, None] > 0), norms


def integer_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows. Doubles are exact below 2 ** 53; beyond, whole numbers of any size are used."""
    top = [int(max(abs(int(m.max())), abs(int(m.min())))) if m.size else 0 for m in (a, b)]
    if a.shape[1] * top[0] * top[1] < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    whole = a.astype(object) @ b.T.astype(object)
    return np.clip(whole, *LONG).astype(np.int64)


def score_bounds(angles: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray, small: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each anchor (its angles and norm) with any row of each zone (ends of angles, norms)."""
    gap = np.zeros((len(angles), len(low)))
    most = np.full((len(angles), len(low)), np.pi)
    for r in range(angles.shape[1]):
        own = angles[:, r, None]
        gap = np.maximum(gap, np.maximum(low[None, :, r] - own, own - high[None, :, r]))
        # The angle between two vectors is at most the sum of theirs to a reference, and at most 2 pi less that sum.
        least, last = own + low[None, :, r], own + high[None, :, r]
        most = np.minimum(most, np.where(last <= np.pi, last, np.where(least >= np.pi, 2 * np.pi - least, np.pi)))
    best, worst = np.cos(np.maximum(gap - SLACK, 0)), np.cos(np.minimum(most + SLACK, np.pi))
    top = norms[:, None] * np.where(best > 0, large[None, :], small[None, :]) * best
    bottom = norms[:, None] * np.where(worst > 0, small[None, :], large[None, :]) * worst
    wide = 1 + 1e-9 * norms[:, None] * large[None, :]
    return bottom - wide, top + wide


class Block:
    """Rows of one zone, sorted by label (if asked for) and the angle to the zone's reference."""

    def __init__(self, rows: pa.Table, reference: int, by_label: bool):
        angles = matrix(rows["angles"], np.float32)
        angle = (angles[:, reference] if angles.shape[1] else np.zeros(len(angles))).astype(np.float64)
        labels = np.array(rows["label"].to_pylist(), object)
        order = np.lexsort((angle, labels) if by_label else (angle,))
        self.angle, self.labels, self.norms = angle[order], labels[order], rows["norm"].to_numpy()[order]
        self.vectors = whole(rows["q"])[order]
        ids = rows["ids"].to_pylist()
        self.ids = [ids[i] for i in order]
        self.first = np.array([i[0] for i in self.ids], np.int64)

    def segment(self, label: str) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, side="right"))

    def windows(self, begin: int, end: int, angle: np.ndarray, norms: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places between ``begin`` and ``end`` where each anchor may find scores from ``least`` to ``most``."""
        own, held = self.angle[begin:end], self.norms[begin:end]
        high, low = norms * held.max(), norms * held.min()
        wide = 1 + 1e-9 * high
        with np.errstate(divide="ignore", invalid="ignore"):
            # A row further than this from the anchor scores less than ``least``.
            reach = np.where(least > wide, np.arccos(np.clip((least - wide) / high, -1, 1)), np.pi) + SLACK
            # A row nearer to the reference than this is so near to the anchor that it scores more than ``most``.
            near = np.where((most >= 0) & (low > 0), np.arccos(np.clip((most + wide) / low, -1, 1)) - angle - SLACK, 0)
        first = np.maximum(np.searchsorted(own, angle - reach), np.searchsorted(own, np.maximum(near, 0)))
        return begin + first, begin + np.maximum(np.searchsorted(own, angle + reach, side="right"), first)

    def best(self, scores: np.ndarray, begin: int, able: np.ndarray, keep: int) -> list[dict]:
        """The ``keep`` best classes among the places ``able`` of ``scores``, which start at ``begin``."""
        if not len(able):
            return []
        found = scores[able]
        if len(able) > keep:
            cut = np.partition(found, len(found) - keep)[len(found) - keep]
            able = able[found >= cut]
            found = scores[able]
        order = np.lexsort((self.first[begin + able], ~found))[:keep]
        return [{"score": int(found[i]), "ids": self.ids[begin + int(able[i])]} for i in order]


def matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """Binary values of one length as rows."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1) if values and values[0] else np.zeros((len(values), 0), kind)


def whole(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(values), -1) if len(values) else np.zeros((0, 0), np.int64)


class Anchors:
    def __init__(self, rows: pa.Table, reference: int):
        angles = matrix(rows["angles"], np.float32)
        self.names, self.labels = rows["class"].to_pylist(), np.array(rows["label"].to_pylist(), object)
        self.angle = (angles[:, reference] if angles.shape[1] else np.zeros(len(angles))).astype(np.float64)
        self.norms, self.vectors = rows["norm"].to_numpy(), whole(rows["q"])


def scored(block: Block, anchors: Anchors, chosen: np.ndarray, begin: int, end: int, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(anchor, first place, scores) over the window of each of the ``chosen`` anchors."""
    if begin == end:
        return
    first, last = block.windows(begin, end, anchors.angle[chosen], anchors.norms[chosen], least, most)
    order = np.argsort(first, kind="stable")
    order = order[last[order] > first[order]]
    for at in range(0, len(order), ANCHORS_AT_ONCE):
        part = order[at : at + ANCHORS_AT_ONCE]
        low, high = int(first[part].min()), int(last[part].max())
        scores = integer_scores(anchors.vectors[chosen[part]], block.vectors[low:high])
        for place, row in zip(part, scores):
            yield int(chosen[place]), int(first[place]), row[first[place] - low : last[place] - low]


def of_same_label(block: Block, anchors: Anchors, floors: np.ndarray, keep: int) -> Iterator[tuple[int, list[dict]]]:
    """(anchor, best classes of its label that reach its floor)."""
    for label in sorted(set(anchors.labels)):
        chosen = np.flatnonzero(anchors.labels == label)
        begin, end = block.segment(label)
        floor = floors[chosen]
        for i, first, scores in scored(block, anchors, chosen, begin, end, floor.astype(np.float64), np.full(len(chosen), np.inf)):
            found = block.best(scores, first, np.flatnonzero(scores >= floors[i]), keep)
            if found:
                yield i, found


def asked(score: int, lowest: int, highest: int) -> tuple[int, int]:
    """The least and the greatest score of a negative; an empty window if the first is the greater."""
    return -(-score * lowest // 100), score * highest // 100


def of_other_labels(block: Block, anchors: Anchors, asks: list[list[int]], lowest: int, highest: int, keep: int) -> Iterator[tuple[int, int, list[dict]]]:
    """(anchor, positive's score, best classes of other labels in its window)."""
    ends = [[asked(s, lowest, highest) for s in scores] for scores in asks]
    least = np.array([min(a for a, _ in e) for e in ends], np.float64)
    most = np.array([max(b for _, b in e) for e in ends], np.float64)
    for i, first, scores in scored(block, anchors, np.arange(len(asks)), 0, len(block.first), least, most):
        other = block.labels[first : first + len(scores)] != anchors.labels[i]
        for score, (low, high) in zip(asks[i], ends[i]):
            found = block.best(scores, first, np.flatnonzero(other & (scores >= low) & (scores <= high)), keep)
            if found:
                yield i, score, found


FOUND = "array<struct<score: bigint, ids: array<bigint>>>"
FOUND_TYPE = pa.list_(pa.struct([("score", pa.int64()), ("ids", pa.list_(pa.int64()))]))


def _classes(vectors: DataFrame, anchors: Column, key: str, vector: str, label: str, scale: float, listed: int) -> tuple[DataFrame, DataFrame]:
    """Classes (class, label, q, ids, anchor) and their anchors (class, anchor_id)."""
    values = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), values.alias("v"), anchors.alias("anchor"))
    unfit = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~unfit)
    rows = rows.withColumn("q", F.transform("v", lambda x: F.floor(x * scale).cast("bigint")))
    name = F.unhex(F.md5(F.concat_ws("|", "label", F.array_join(F.col("q").cast("array<string>"), ","))))
    rows = rows.select(name.alias("class"), "id", "label", "q", F.coalesce("anchor", F.lit(False)).alias("anchor"))
    # Only a few rows of a class can be listed; the window drops the others before the shuffle.
    single = cut_lineage(rows.groupBy("class", "id").agg(F.max("anchor").alias("anchor"), F.first("label").alias("label"), F.first("q").alias("q")))
    least = Window.partitionBy("class").orderBy("id")
    members = single.withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= listed)
    some = single.where("anchor").groupBy("class").agg(F.lit(True).alias("anchor"))
    classes = members.groupBy("class").agg(F.first("label").alias("label"), F.first("q").alias("q"), F.sort_array(F.collect_list("id")).alias("ids"))
    return classes.join(some, "class", "left").withColumn("anchor", F.coalesce("anchor", F.lit(False))), single.where("anchor").select("class", F.col("id").alias("anchor_id"))


def _placed(classes: DataFrame, references: References) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("q").to_pylist()
            norms, angles, zones = [0.0] * len(vectors), [b""] * len(vectors), [0] * len(vectors)
            lengths: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                lengths.setdefault(len(v), []).append(i)
            for length, places in lengths.items():
                unit, own = units(np.array([vectors[i] for i in places], np.float64).reshape(len(places), length))
                found = references.angles(unit) if length else np.zeros((len(places), 1))
                for i, n, a, z in zip(places, own, found.astype(np.float32), references.zones(found, length)):
                    norms[i], angles[i], zones[i] = float(n), a.tobytes(), int(z)
            extra = pa.array(norms, pa.float64()), pa.array(angles, pa.binary()), pa.array(zones, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "norm", "angles", "zone"])

    schema = "class binary, label string, q array<bigint>, ids array<bigint>, anchor boolean, norm double, angles binary, zone bigint"
    return in_small_batches(classes.select("class", "label", "q", "ids", "anchor")).mapInArrow(run, schema)


def _zone_ends(placed: DataFrame) -> list:
    """Per zone: rows, ends of every stored angle, ends of the norm. Tasks and then zones are reduced; few rows come back."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            zones = batch.column("zone").to_numpy()
            for zone in np.unique(zones):
                part = batch.filter(pa.array(zones == zone))
                low, high = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.float32).reshape(part.num_rows, -1) for c in ("low", "high"))
                small, large = part.column("small").to_numpy(), part.column("large").to_numpy()
                now = [int(np.sum(part.column("n").to_numpy())), low.min(0), high.max(0), small.min(), large.max()]
                if zone in held:
                    n, a, b, c, d = held[zone]
                    now = [now[0] + n, np.minimum(now[1], a), np.maximum(now[2], b), min(now[3], c), max(now[4], d)]
                held[int(zone)] = now
        if held:
            n, low, high, small, large = zip(*held.values())
            columns = [list(held), n, [x.tobytes() for x in low], [x.tobytes() for x in high], small, large]
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["zone", "n", "low", "high", "small", "large"])

    schema = "zone bigint, n bigint, low binary, high binary, small double, large double"
    rows = placed.select("zone", F.lit(1).cast("bigint").alias("n"), F.col("angles").alias("low"), F.col("angles").alias("high"), F.col("norm").alias("small"), F.col("norm").alias("large"))
    once = in_small_batches(rows).mapInArrow(reduce, schema)
    return once.repartition("zone").mapInArrow(reduce, schema).collect()


class Zones:
    """The bounds of all zones, and which of them an anchor visits."""

    def __init__(self, rows: list):
        self.by_length: dict[int, tuple] = {}
        groups: dict[int, list] = {}
        for r in rows:
            groups.setdefault(r["zone"] // FAR, []).append(r)
        for length, own in groups.items():
            low, high = (np.array([np.frombuffer(r[c], np.float32) for r in own], np.float64) for c in ("low", "high"))
            small, large = (np.array([r[c] for r in own]) for c in ("small", "large"))
            self.by_length[length] = np.array([r["zone"] for r in own]), low, high, small, large

    def visited(self, length: int, angles: np.ndarray, norms: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (anchor, zone number) where scores from ``least`` to ``most`` may lie."""
        numbers, *ends = self.by_length[length]
        bottom, top = score_bounds(angles, norms, *ends)
        anchor, zone = np.nonzero((top >= least[:, None]) & (bottom <= most[:, None]))
        return anchor, numbers[zone]


def _visits(anchors: DataFrame, zones: Zones, extra: str, ends) -> DataFrame:
    """Rows of ``anchors`` once for each zone they visit. ``ends`` turns the column ``extra`` of one row into its two scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([z // FAR for z in batch.column("home").to_pylist()], np.int64)
            for length in np.unique(lengths):
                places = np.flatnonzero(lengths == length)
                part = batch.take(pa.array(places))
                pairs = np.array([ends(x) for x in part.column(extra).to_pylist()], np.float64).reshape(len(places), 2)
                for at in range(0, len(places), ANCHORS_AT_ONCE):
                    some = slice(at, at + ANCHORS_AT_ONCE)
                    angles = matrix(pa.chunked_array([part.column("angles")])[some], np.float32).astype(np.float64)
                    anchor, zone = zones.visited(int(length), angles, part.column("norm").to_numpy()[some], pairs[some, 0], pairs[some, 1])
                    if len(anchor):
                        rows = part.take(pa.array(anchor + at))
                        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(zone, pa.int64())], names=[*rows.schema.names, "zone"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return in_small_batches(anchors).mapInArrow(run, f"{kinds}, zone bigint")


def _meet(visits: DataFrame, rows: DataFrame, parts: DataFrame, score, schema: str) -> DataFrame:
    """``score(anchors, rows)`` over every tile: a block of a zone and a bounded number of the anchors that visit it."""
    tiles = visits.groupBy("zone").agg(F.ceil(F.count("*") / TILE_ANCHORS).cast("int").alias("tiles")).join(F.broadcast(parts), "zone")
    visiting = visits.join(F.broadcast(tiles), "zone").withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int"))
    visiting = visiting.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "tiles")
    visiting = visiting.where((F.col("zone") != F.col("home")) | (F.col("part") != F.col("home_part")))
    met = rows.join(F.broadcast(tiles.select("zone", "tiles")), "zone").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    keys = ["zone", "part", "tile"]
    return visiting.groupBy(*keys).cogroup(met.drop("tiles").groupBy(*keys)).applyInArrow(score, schema)


def mine(
    vectors: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows that ``anchors`` selects."""
    listed = max(positives + 1, negatives)
    classes, anchor_ids = _classes(vectors, anchors, key, vector, label, scale, listed)
    classes = cut_lineage(classes)
    total = classes.count()
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if total == 0:
        return vectors.sparkSession.createDataFrame([], out)
    sample = [r["q"] for r in classes.orderBy("class").limit(SAMPLE).select("q").collect()]
    bands = max(1, min(BANDS, total // (BLOCK_ROWS * REFERENCES)))
    references = References(sample, REFERENCES, bands)
    ends = _zone_ends(_placed(classes, references))
    sizes = [(r["zone"], max(1, -(-r["n"] // BLOCK_ROWS))) for r in ends]
    zones = Zones(ends)
    parts = vectors.sparkSession.createDataFrame(sizes, "zone bigint, parts int")
    rows = _placed(classes, references).join(F.broadcast(parts), "zone")
    rows = cut_lineage(rows.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).drop("parts"))

    keep = positives + 1

    def at_home(block_rows: pa.Table) -> pa.Table:
        reference = references.reference(block_rows["zone"][0].as_py())
        own = Anchors(block_rows.filter(block_rows["anchor"]), reference)
        names, floors, founds = [], [], []
        if own.names:
            block = Block(block_rows, reference, True)
            for i, found in of_same_label(block, own, np.full(len(own.names), LONG[0]), keep):
                scores = [f["score"] for f in found for _ in f["ids"]]
                names.append(own.names[i])
                floors.append(scores[keep - 1] if len(scores) >= keep else LONG[0])
                founds.append(found)
        return pa.table({"class": pa.array(names, pa.binary()), "floor": pa.array(floors, pa.int64()), "found": pa.array(founds, FOUND_TYPE)})

    home = cut_lineage(rows.groupBy("zone", "part").applyInArrow(at_home, f"class binary, floor bigint, found {FOUND}"))
    base = rows.where("anchor").select("class", "label", "q", "norm", "angles", F.col("zone").alias("home"), F.col("part").alias("home_part"))
    slim = rows.select("zone", "part", "label", "q", "ids", "norm", "angles")

    def same(own: pa.Table, block_rows: pa.Table) -> pa.Table:
        names, founds = [], []
        if own.num_rows and block_rows.num_rows:
            reference = references.reference(block_rows["zone"][0].as_py())
            visitors = Anchors(own, reference)
            for i, found in of_same_label(Block(block_rows, reference, True), visitors, own["floor"].to_numpy(), keep):
                names.append(visitors.names[i])
                founds.append(found)
        return pa.table({"class": pa.array(names, pa.binary()), "found": pa.array(founds, FOUND_TYPE)})

    seeking = base.join(home.select("class", "floor"), "class")
    abroad = _meet(_visits(seeking, zones, "floor", lambda floor: (floor, np.inf)), slim, parts, same, f"class binary, found {FOUND}")
    listed_rows = home.select("class", "found").unionByName(abroad).select("class", F.inline("found")).select("class", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("class").orderBy(F.desc("score"), "id")
    chosen = listed_rows.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= keep)
    chosen = cut_lineage(chosen.groupBy("class").agg(F.sort_array(F.collect_list(F.struct(F.col("_r").alias("r"), "id", "score"))).alias("near")))

    def other(own: pa.Table, block_rows: pa.Table) -> pa.Table:
        names, scores, founds = [], [], []
        if own.num_rows and block_rows.num_rows:
            reference = references.reference(block_rows["zone"][0].as_py())
            visitors = Anchors(own, reference)
            for i, score, found in of_other_labels(Block(block_rows, reference, False), visitors, own["asks"].to_pylist(), lowest, highest, negatives):
                names.append(visitors.names[i])
                scores.append(score)
                founds.append(found)
        return pa.table({"class": pa.array(names, pa.binary()), "positive_score": pa.array(scores, pa.int64()), "found": pa.array(founds, FOUND_TYPE)})

    def span(asks: list[int]) -> tuple[float, float]:
        pairs = [asked(s, lowest, highest) for s in asks]
        return min(a for a, _ in pairs), max(b for _, b in pairs)

    asks = F.array_distinct(F.transform("near", lambda n: n["score"]))
    # Window ends are integers: below zero the lower one exceeds the upper one, and nothing is asked for.
    low, high = (F.ceil, lowest), (F.floor, highest)
    able = F.filter(asks, lambda s: low[0](s.cast("decimal(38,0)") * low[1] / 100) <= high[0](s.cast("decimal(38,0)") * high[1] / 100))
    wanting = base.join(chosen.select("class", able.alias("asks")).where(F.size("asks") > 0), "class")
    # The home block was scored for one label only, so it is visited like any other.
    wanting = wanting.withColumn("home_part", F.lit(-1))
    met = _meet(_visits(wanting, zones, "asks", span), slim, parts, other, f"class binary, positive_score bigint, found {FOUND}")
    near = met.select("class", "positive_score", F.inline("found")).select("class", "positive_score", "score", F.explode("ids").alias("id"))
    first = Window.partitionBy("class", "positive_score").orderBy(F.desc("score"), "id")
    near = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    answers = near.groupBy("class").agg(F.collect_list(F.struct("positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))).alias("negatives"))
    answers = answers.join(chosen, "class")

    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("anchor_id")), 1, positives)
    pairs = join_hot(cut_lineage(anchor_ids), answers, "class").select("anchor_id", "negatives", F.explode(others).alias("p"))
    own = F.filter("negatives", lambda n: n["positive_score"] == F.col("p.score"))
    return pairs.select("anchor_id", F.col("p.id").alias("positive_id"), F.inline(own)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
