"""Radius search and nearest-N over geographic points, without comparing all pairs.

Targets are sorted along a curve through a cube grid over the sphere and cut into tiles of bounded size, each inside one
cell of the grid. Sources are sorted in the same way. A run of neighbouring sources is measured against the tiles' boxes
alone: the tiles that are sure to hold N targets bound the distance, tiles farther away are dropped, and a run that would
still meet too many is split. What is left is a block of sources with the few tiles that can hold its nearest, and one
task call finds them as a matrix of distances. Pairs of points are never written, a city that holds a third of all
listings costs no more per source than a village, and the result is exact.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodgeframe.functions.geo import EARTH_RADIUS_M, haversine_m, on_sphere
from lodgeframe.session import cut_lineage

# The task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Distances are ranked at this resolution (decimal places of a kilometre), then by id.
RANK_PLACES = 6
AXES = ("x", "y", "z")
SLACK_M = 0.002
# A tile or block of no more than this many points is not split for its size. Boxes of tiles go to every task, so tiles
# grow with the square root of the targets.
UNSPLIT = 512
# A block that would meet more targets than this many full tiles is split, if its sources lie apart.
MOST_TILES = 64
# Points of one range, and numbers of one matrix of distances.
RANGE_ROWS = 16_384
MATRIX_NUMBERS = 2_000_000
# Halvings of the cube that one 63-bit code holds; a second code goes on inside the last cell (6 m wide).
HALVINGS = 21


def within_radius(points: DataFrame, lat: float, lon: float, radius_km: float = 5, limit: int = 20) -> DataFrame:
    """The ``limit`` rows of ``points`` (``id, lat, lon, ...``) nearest to one place, with ``distance_km``."""
    km = haversine_m(F.lit(float(lat)), F.lit(float(lon)), F.col("lat"), F.col("lon")) / 1000
    # A latitude band is a plain comparison that reaches the file scan.
    band = radius_km / 111.0
    near = points.where(F.col("lat").between(lat - band, lat + band)).withColumn("_km", km).where(F.col("_km") <= radius_km)
    top = near.orderBy(F.round("_km", RANK_PLACES), "id").limit(limit)
    return top.withColumn("distance_km", F.round("_km", 2)).drop("_km")


def _smallest_ids_per_place(targets: DataFrame, keep: int) -> DataFrame:
    """Targets of each distinct place, at most the ``keep`` smallest ids; no others can be among the nearest."""
    w = Window.partitionBy("lat", "lon").orderBy("id")
    return targets.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= keep).drop("_rank")


def sphere_points(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Metres along three axes, one row per point."""
    phi, lam = np.radians(lat), np.radians(lon)
    return EARTH_RADIUS_M * np.column_stack([np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)])


def _interleaved(cells: np.ndarray) -> np.ndarray:
    """The 21 low bits of three columns as one code, the highest bits of all three first."""
    out = np.zeros(len(cells), np.int64)
    for bit in range(HALVINGS):
        for axis in range(3):
            out |= ((cells[:, axis] >> bit) & 1) << (3 * bit + axis)
    return out


def curve_codes(xyz: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each point on the curve: its cell of the cube, and its cell within that cell."""
    parts = 1 << HALVINGS
    scaled = (xyz / (2.001 * EARTH_RADIUS_M) + 0.5) * parts
    coarse = np.clip(np.floor(scaled), 0, parts - 1)
    fine = np.clip(np.floor((scaled - coarse) * parts), 0, parts - 1)
    return _interleaved(coarse.astype(np.int64)), _interleaved(fine.astype(np.int64))


def _along_curve(points: DataFrame, rows: int) -> DataFrame:
    """``points`` with their codes, in ranges of bounded size, sorted."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coarse, fine = curve_codes(sphere_points(batch.column("lat").to_numpy(), batch.column("lon").to_numpy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(coarse), pa.array(fine)], names=[*batch.schema.names, "code", "fine"])

    schema = T.StructType([*points.schema.fields, T.StructField("code", T.LongType()), T.StructField("fine", T.LongType())])
    order = ["code", "fine", "id"]
    return points.mapInArrow(code, schema).repartitionByRange(max(1, -(-rows // RANGE_ROWS)), *order).sortWithinPartitions(*order)


def _halves(codes: tuple[np.ndarray, np.ndarray], begin: int, end: int, level: int) -> tuple[list[tuple[int, int]], int]:
    """The next cells that part the sorted points ``begin:end``, and the level below them; one part if none does."""
    while level < 2 * HALVINGS:
        code, shift = codes[level // HALVINGS], 3 * (HALVINGS - 1 - level % HALVINGS)
        level += 1
        if code[begin] >> shift != code[end - 1] >> shift:
            cells = code[begin:end] >> shift
            edges = [begin, *(np.flatnonzero(cells[1:] != cells[:-1]) + begin + 1).tolist(), end]
            return list(zip(edges[:-1], edges[1:])), level
    return [(begin, end)], level


def _joined(parts: list[tuple[int, int]], cap: int) -> list[tuple[int, int]]:
    """Neighbouring parts put together up to ``cap`` points."""
    out = parts[:1]
    for begin, end in parts[1:]:
        if end - out[-1][0] <= cap:
            out[-1] = (out[-1][0], end)
        else:
            out.append((begin, end))
    return out


def tile_ranges(codes: tuple[np.ndarray, np.ndarray], cap: int) -> list[tuple[int, int]]:
    """Runs of sorted points of at most ``cap``, each inside one cell; more than that in the finest cell are cut by number."""
    out, todo = [], [(0, len(codes[0]), 0)] if len(codes[0]) else []
    while todo:
        begin, end, level = todo.pop()
        if end - begin <= cap:
            out.append((begin, end))
            continue
        parts, below = _halves(codes, begin, end, level)
        if len(parts) == 1:
            parts = [(at, min(at + cap, end)) for at in range(begin, end, cap)]
        todo.extend((a, b, below) for a, b in _joined(parts, cap))
    return sorted(out)


class Boxes:
    """Boxes of the tiles in metres, with their numbers of targets."""

    def __init__(self, tile: np.ndarray, low: np.ndarray, high: np.ndarray, w: np.ndarray):
        self.tile, self.low, self.high, self.w = tile, low, high, w

    def reached(self, xyz: np.ndarray, some: np.ndarray, reach: float, keep: int) -> np.ndarray:
        """Those of ``some`` tiles that can hold one of the ``keep`` nearest targets of one of the points."""
        low, high = xyz.min(0), xyz.max(0)
        gap = np.maximum(0, np.maximum(self.low[some] - high, low - self.high[some]))
        span = np.maximum(high - self.low[some], self.high[some] - low)
        nearest, farthest = (np.sqrt((d * d).sum(1)) for d in (gap, span))
        order = np.argsort(farthest)
        enough = np.searchsorted(np.cumsum(self.w[some][order]), keep)
        bound = min(reach, farthest[order[enough]]) if enough < len(order) else reach
        return some[nearest <= bound + SLACK_M]


def block_ranges(xyz: np.ndarray, codes: tuple[np.ndarray, np.ndarray], boxes: Boxes, reach: float, keep: int, cap: int) -> list[tuple[int, int, np.ndarray]]:
    """Runs of sorted sources, each with the places of the tiles it must meet; sources that meet none are left out."""
    out, todo = [], [(0, len(xyz), 0, np.arange(len(boxes.tile)))] if len(xyz) else []
    while todo:
        begin, end, level, some = todo.pop()
        some = boxes.reached(xyz[begin:end], some, reach, keep)
        if not len(some):
            continue
        crowded = end - begin > cap
        if not crowded and (end - begin == 1 or boxes.w[some].sum() <= MOST_TILES * cap):
            out.append((begin, end, some))
            continue
        parts, below = _halves(codes, begin, end, level)
        if len(parts) > 1:
            todo.extend((a, b, below, some) for a, b in (_joined(parts, cap) if crowded else parts))
        else:
            out.extend((at, min(at + cap, end), some) for at in range(begin, end, cap))
    return out


def _chord(metres: float) -> float:
    """Straight-line length of a way on the surface."""
    return 2 * EARTH_RADIUS_M * math.sin(min(metres / (2 * EARTH_RADIUS_M), math.pi / 2))


def _haversine(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle distance in kilometres."""
    phi1, phi2 = np.radians(lat1), np.radians(lat2)
    a = np.sin(np.radians(lat2 - lat1) / 2) ** 2 + np.cos(phi1) * np.cos(phi2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(1.0, a))) / 1000


def _rank_order(i: np.ndarray, km: np.ndarray, j: np.ndarray, targets: int) -> np.ndarray:
    """Order by place, rounded distance and target; one sort of whole numbers, if they fit."""
    units = np.rint(km * 10**RANK_PLACES).astype(np.int64)
    kinds = int(units.max(initial=0)) + 1
    if (int(i.max(initial=0)) + 1) * kinds * targets < 1 << 63:
        return np.argsort((i * kinds + units) * targets + j)
    return np.lexsort((j, units, i))


def nearest_of_places(lat: np.ndarray, lon: np.ndarray, t_lat: np.ndarray, t_lon: np.ndarray, radius_km: float, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, target, kilometres) of the ``keep`` nearest targets of each place, nearest first; targets come in the order of their ids."""
    here, there = sphere_points(lat, lon), sphere_points(t_lat, t_lon)
    # Near the origin squares of lengths lose little by rounding.
    middle = here.mean(0)
    here, there = here - middle, there - middle
    here2, there2 = (here * here).sum(1), (there * there).sum(1)
    blur = 1e-13 * max(here2.max(), there2.max())
    farthest = (_chord(radius_km * 1000) + SLACK_M) ** 2 + blur
    found = []
    step = max(1, MATRIX_NUMBERS // len(there))
    for begin in range(0, len(here), step):
        part = slice(begin, begin + step)
        squares = here2[part, None] + there2[None, :] - 2 * (here[part] @ there.T)
        limits = np.full(len(squares), farthest)
        if len(there) > keep:
            last = np.maximum(np.partition(squares, keep - 1, axis=1)[:, keep - 1], 0) + blur
            limits = np.minimum(limits, (np.sqrt(last) + SLACK_M) ** 2 + blur)
        i, j = np.nonzero(squares <= limits[:, None])
        i += begin
        km = _haversine(lat[i], lon[i], t_lat[j], t_lon[j])
        inside = km <= radius_km
        i, j, km = i[inside], j[inside], km[inside]
        order = _rank_order(i - begin, km, j, len(there))
        i, j, km = i[order], j[order], km[order]
        kept = np.arange(len(i)) - np.searchsorted(i, i) < keep
        found.append((i[kept], j[kept], km[kept]))
    return tuple(np.concatenate(column) for column in zip(*found))


def _block_nearest(left: pa.Table, right: pa.Table, radius_km: float, limit: int) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """(source id, id, rank, kilometres) of one block of sources and the targets of its tiles."""
    ids = right.column("id").combine_chunks()
    right = right.take(pc.sort_indices(ids))
    ids = right.column("id").combine_chunks()
    known = pc.unique(ids)
    code = pc.index_in(ids, known).to_numpy(zero_copy_only=False)
    source_ids = left.column("id").combine_chunks()
    own = pc.fill_null(pc.index_in(source_ids.cast(ids.type), known), -1).to_numpy(zero_copy_only=False)
    place, of = np.unique(left.column("lat").to_numpy() + 1j * left.column("lon").to_numpy(), return_inverse=True)
    # The source itself may be among the nearest.
    i, j, km = nearest_of_places(place.real, place.imag, right.column("lat").to_numpy(), right.column("lon").to_numpy(), radius_km, limit + 1)
    first, n = np.searchsorted(i, np.arange(len(place))), np.bincount(i, minlength=len(place))
    row = np.repeat(np.arange(len(of)), n[of])
    at = np.arange(len(row)) - np.repeat(np.cumsum(n[of]) - n[of], n[of]) + first[of][row]
    other = code[j[at]] != own[row]
    row, at = row[other], at[other]
    rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
    row, at, rank = row[rank <= limit], at[rank <= limit], rank[rank <= limit]
    return source_ids.take(pa.array(row)), ids.take(pa.array(j[at])), rank.astype(np.int32), km[at]


def _numbered(ranges: list[tuple[int, int]], rows: int) -> np.ndarray:
    """Number of the run that each row lies in, unique over all tasks; -1 for none."""
    out = np.full(rows, -1, np.int64)
    context = TaskContext.get()
    first = (context.partitionId() if context else 0) << 32
    for number, (begin, end) in enumerate(ranges):
        out[begin:end] = first + number
    return out


def nearest(
    sources: DataFrame,
    targets: DataFrame,
    radius_km: float = 5,
    limit: int = 20,
    crowd: int | None = None,
) -> DataFrame:
    """For each source the ``limit`` nearest targets within ``radius_km``, the source itself left out.

    ``sources`` and ``targets`` carry ``id, lat, lon``; rows without a valid point give nothing. Returns
    ``(source_id, id, rank, distance_km)`` with the distance rounded to two places. Equal distances are
    ordered by id. ``crowd`` is the number of points up to which a tile is not split further.
    """
    keep = limit + 1  # the source itself may be among the nearest

    def valid(points: DataFrame) -> DataFrame:
        inside = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & F.col("id").isNotNull()
        return points.where(inside).select("id", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))

    candidates = cut_lineage(_smallest_ids_per_place(valid(targets), keep))
    rows = candidates.count()
    cap = max(crowd or UNSPLIT, keep, math.isqrt(rows) // 4)
    reach = _chord(radius_km * 1000) + SLACK_M
    target_schema, source_schema = candidates.schema, valid(sources).schema

    def whole(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray, tuple[np.ndarray, np.ndarray]] | None:
        held = [b for b in batches if b.num_rows]
        if not held:
            return None
        points = pa.Table.from_batches(held)
        codes = points.column("code").to_numpy(), points.column("fine").to_numpy()
        return points.select(["id", "lat", "lon"]), sphere_points(points.column("lat").to_numpy(), points.column("lon").to_numpy()), codes

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = whole(batches)
        if held is not None:
            numbers = _numbered(tile_ranges(held[2], cap), held[0].num_rows)
            yield from held[0].append_column("tile", pa.array(numbers)).to_batches()

    # Ranges are sampled, so their bounds must not be drawn again when the rows are read twice.
    tiled = cut_lineage(_along_curve(candidates, rows).mapInArrow(tile, T.StructType([*target_schema.fields, T.StructField("tile", T.LongType())])))
    axes = dict(zip(AXES, on_sphere(F.col("lat"), F.col("lon"))))
    edges = [f(axes[a]).alias(f"{n}{a}") for n, f in (("low_", F.min), ("high_", F.max)) for a in AXES]
    held = tiled.groupBy("tile").agg(F.count("*").alias("w"), *edges).toPandas()  # of the order of the root of the targets, or one of 512
    boxes = Boxes(held["tile"].to_numpy(), *(held[[f"{n}{a}" for a in AXES]].to_numpy() for n in ("low_", "high_")), held["w"].to_numpy())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = whole(batches)
        if held is None:
            return
        points, xyz, codes = held
        blocks = block_ranges(xyz, codes, boxes, reach, keep, cap)
        met = {begin: boxes.tile[some] for begin, _, some in blocks}
        tiles = pa.array([met.get(i) for i in range(len(xyz))], pa.list_(pa.int64()))
        routed = points.append_column("block", pa.array(_numbered([b[:2] for b in blocks], len(xyz)))).append_column("tiles", tiles)
        yield from routed.filter(pc.greater_equal(routed.column("block"), 0)).to_batches()

    points = cut_lineage(valid(sources))
    block = [T.StructField("block", T.LongType()), T.StructField("tiles", T.ArrayType(T.LongType()))]
    routed = cut_lineage(_along_curve(points, points.count()).mapInArrow(route, T.StructType([*source_schema.fields, *block])))
    # The first row of a block names its tiles.
    meets = routed.where(F.col("tiles").isNotNull()).select("block", F.explode("tiles").alias("tile"))
    gathered = meets.join(tiled, "tile").select(F.col("block").alias("for_block"), "id", "lat", "lon")
    id_types = [T.StructField(n, s["id"].dataType) for n, s in (("source_id", source_schema), ("id", target_schema))]
    out = T.StructType([*id_types, T.StructField("rank", T.IntegerType()), T.StructField("_exact", T.DoubleType())])

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["source_id", "id", "rank", "_exact"]
        if not left.num_rows or not right.num_rows:
            return pa.table([left.column("id").slice(0, 0), right.column("id").slice(0, 0), pa.array([], pa.int32()), pa.array([], pa.float64())], names=names)
        return pa.table([pa.chunked_array([c]) if isinstance(c, pa.Array) else pa.array(c) for c in _block_nearest(left, right, radius_km, limit)], names=names)

    found = routed.drop("tiles").groupBy("block").cogroup(gathered.groupBy("for_block")).applyInArrow(find, out)
    return found.select("source_id", "id", "rank", F.round("_exact", 2).alias("distance_km"))
