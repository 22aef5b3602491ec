"""Top-k cosine search over vectors.

Three forms. ``similar_to`` answers for given ids: few queries travel to one scan of the corpus, each task keeping its
own k best; more are dealt out in blocks that meet the corpus's blocks. ``similar_all`` answers for every vector,
exactly: equal vectors are collapsed, the rest is divided around two levels of pivots, about the square root of the
vectors in all. What is shuffled is a super-block, a part of a first-level pivot's vectors as large as a task may hold.
Two super-blocks meet once and are scored both ways, so a vector is copied only once for each super-block within its
reach; inside a pair of super-blocks the second level skips the cells that cannot hold a neighbour, by the triangle
inequality on angles. ``similar_lsh`` is the approximate form for corpora where little
can be skipped: vectors meet only where they lie on the same side of all random hyperplanes of some table, so each is
copied a fixed number of times. Blocks are scored as matrix products and hand on k rows per vector; no form writes
out all pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgeframe.session import at_most, cut_lineage

# The task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Scores are ranked at this many decimal places, then by id.
RANK_PLACES = 6
# The most query vectors that one scan carries, and the rows of a block where both sides are dealt out.
QUERY_GROUP = 2_000
BLOCK_ROWS = 4_096
# First-level pivots that deal the work out widely enough: 16 make 136 pairs.
SUPERS = 16
# Numbers of the vectors of a super-block, and scores that are held at once, where all vectors are compared.
BLOCK_NUMBERS = 4_194_304
SCORES_HELD = 4_194_304
# Tables and hyperplanes of the approximate form: two vectors at cosine 0.9 share one of 24 tables of 8 planes in 99.9 % of pairs.
TABLES, PLANES = 24, 8
# Slack for the pruning bound: rounding of scores and of angles.
_SLACK = 1e-4


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Unit rows; a vector without length stays zero and scores 0 against everything."""
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.round(a @ b.T, RANK_PLACES) + 0.0


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Positions of the k best columns per row, by score and then by id."""
    keep = min(k, scores.shape[1])
    if not keep:
        return [np.zeros(0, np.int64)] * len(scores)
    cuts = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep]
    out = []
    for row, cut in zip(scores, cuts):
        able = np.flatnonzero(row >= cut)
        out.append(able[np.lexsort((ids[able], -row[able]))[:keep]])
    return out


def _take_top(candidates: DataFrame, k: int) -> DataFrame:
    """``(source_id, id, rank, score)`` from ``(source_id, id, score)``."""
    w = Window.partitionBy("source_id").orderBy(F.desc("score"), "id")
    ranked = candidates.where(F.col("source_id") != F.col("id")).withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= k).select("source_id", "id", "rank", "score")


def _corpus(vectors: DataFrame, published_only: bool) -> DataFrame:
    return vectors.where("published") if published_only else vectors


def similar_to(vectors: DataFrame, ids: DataFrame, k: int = 5, published_only: bool = True) -> DataFrame:
    """The ``k`` vectors most similar to each of ``ids.id``; unknown ids give no rows.

    ``vectors`` carries ``id, vector, published``; NULL vectors are never compared. At most ``QUERY_GROUP`` query vectors
    travel to the tasks of one scan. More stay in Spark: blocks of them meet blocks of the corpus.
    """
    known = vectors.where(_usable("vector"))
    queries = cut_lineage(known.join(ids.select("id"), "id", "left_semi").select("id", "vector"))
    id_type = vectors.schema["id"].dataType.simpleString()
    corpus = _corpus(known, published_only).select("id", "vector")
    if at_most(queries, QUERY_GROUP):
        return _take_top(_scan(corpus, queries.toPandas(), k, id_type), k)
    return _take_top(_block_join(queries, corpus, k, id_type), k)


def _block_join(queries: DataFrame, corpus: DataFrame, k: int, id_type: str) -> DataFrame:
    """Candidates of many queries: each block of them meets each block of the corpus, ``k`` and one per query go on."""
    corpus = cut_lineage(corpus)
    parts = [max(1, -(-df.count() // BLOCK_ROWS)) for df in (queries, corpus)]
    own = [F.pmod(F.xxhash64("id"), F.lit(n)).cast("int") for n in parts]
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in parts]
    left = queries.withColumn("q_part", own[0]).withColumn("c_part", every[1])
    right = corpus.withColumn("c_part", own[1]).withColumn("q_part", every[0])

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = []
        for length, part in q.groupby(q["vector"].map(len)) if len(c) else ():
            other = c[c["vector"].map(len) == length]
            if len(other):
                found.append(_picked(part["id"].to_numpy(), part["vector"], other["id"].to_numpy(), other["vector"], k + 1))
        return pd.concat(found) if found else pd.DataFrame({"source_id": [], "id": [], "score": []})

    keys = ["q_part", "c_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, f"source_id {id_type}, id {id_type}, score double")


def _picked(q_ids: np.ndarray, q_vectors: pd.Series, c_ids: np.ndarray, c_vectors: pd.Series, keep: int) -> pd.DataFrame:
    scores = _scores(_matrix(q_vectors), _matrix(c_vectors))
    picked = _best(scores, c_ids, keep)
    return pd.DataFrame(
        {
            "source_id": np.repeat(q_ids, [len(p) for p in picked]),
            "id": c_ids[np.concatenate(picked)],
            "score": np.concatenate([scores[i, p] for i, p in enumerate(picked)]),
        }
    )


def _usable(vector: str):
    """Vectors that can be compared: not NULL, not empty, without NULL parts."""
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull())


def _scan(corpus: DataFrame, held: pd.DataFrame, k: int, id_type: str) -> DataFrame:
    """Candidates of one group of query vectors: each task keeps ``k`` and one for each of them. Vectors of another
    length than a query's are not compared with it."""
    by_length = {n: (g["id"].to_numpy(), _matrix(g["vector"])) for n, g in held.groupby(held["vector"].map(len))} if len(held) else {}

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            for length, part in batch.groupby(batch["vector"].map(len)):
                if length not in by_length:
                    continue
                query_ids, query_matrix = by_length[length]
                corpus_ids = part["id"].to_numpy()
                scores = _scores(query_matrix, _matrix(part["vector"]))
                picked = _best(scores, corpus_ids, k + 1)
                rows = pd.DataFrame(
                    {
                        "source_id": np.repeat(query_ids, [len(p) for p in picked]),
                        "id": np.concatenate([corpus_ids[p] for p in picked]),
                        "score": np.concatenate([scores[i, p] for i, p in enumerate(picked)]),
                    }
                )
                best = rows if best is None else pd.concat([best, rows])
                best = best.sort_values(["source_id", "score", "id"], ascending=[True, False, True]).groupby("source_id").head(k + 1)
        if best is not None:
            yield best

    return corpus.mapInPandas(scan, f"source_id {id_type}, id {id_type}, score double")


class Pivots:
    """Two levels of pivots: a bounded sample of unit vectors, some of which stand for the others nearest to them."""

    def __init__(self, sample: np.ndarray, supers: int | None = None):
        supers = supers or max(1, int(np.ceil(np.sqrt(len(sample)))))
        self.supers = sample[:supers]
        of = (sample @ self.supers.T).argmax(axis=1)
        of[:supers] = np.arange(supers)
        # Cells are numbered by super pivot, so those of one lie side by side.
        self.of = np.sort(of, kind="stable")
        self.cells = sample[np.argsort(of, kind="stable")]
        self.ends = np.searchsorted(self.of, np.arange(supers + 1))

    def place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(super pivot, angle to it, nearest cell, angle to its pivot) of each row; a zero vector is as far as can be."""
        scores = unit @ self.cells.T
        cell = scores.argmax(axis=1)
        best = self.of[cell]
        narrow = _angle(scores[np.arange(len(cell)), cell])
        wide = _angle((unit * self.supers[best]).sum(axis=1))
        lost = np.linalg.norm(unit, axis=1) == 0
        wide[lost] = narrow[lost] = np.pi
        return best, wide, cell, narrow


def _angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


class Reach:
    """Cell summaries, a few numbers for each pivot: the widest angle of a cell's queries and corpus vectors, and the
    angle within which each of its queries has enough neighbours."""

    def __init__(self, pivots: Pivots, cells: pd.DataFrame, nearest: pd.DataFrame, keep: int):
        count = len(pivots.cells)
        self.queries, self.held, self.floors = np.full(count, -np.inf), np.full(count, -np.inf), np.full(count, np.pi)
        at = cells["cell"].to_numpy(int)
        self.queries[at] = cells["queries"].to_numpy(float)
        self.held[at] = np.where(cells["held"].isna(), -np.inf, cells["held"].to_numpy(float))
        by_cell = {c: (g["angle"].to_numpy(), g["w"].to_numpy()) for c, g in nearest.groupby("cell")}
        for s in range(len(pivots.supers)):
            own = [c for c in range(pivots.ends[s], pivots.ends[s + 1]) if c in by_cell]
            if not own:
                continue
            angles, weights = (np.concatenate([by_cell[c][i] for c in own]) for i in (0, 1))
            sizes = [len(by_cell[c][0]) for c in own]
            for q in range(pivots.ends[s], pivots.ends[s + 1]):
                if np.isfinite(self.queries[q]):
                    reachable = np.repeat(_angle(pivots.cells[own] @ pivots.cells[q]), sizes) + self.queries[q] + angles
                    order = np.argsort(reachable)
                    enough = np.searchsorted(np.cumsum(weights[order]), keep)
                    if enough < len(order):
                        self.floors[q] = min(np.pi, reachable[order][enough])

    def cells(self, pivots: Pivots, q: int, others: np.ndarray) -> np.ndarray:
        """Which of the corpus cells ``others`` may hold a neighbour of a query of cell ``q``."""
        between = _angle(pivots.cells[others] @ pivots.cells[q])
        return others[between - self.queries[q] - self.held[others] <= self.floors[q] + _SLACK]

    def supers(self, pivots: Pivots, widest: dict[int, float], held: dict[int, float]) -> list[tuple[int, int]]:
        """Pairs (super pivot of queries, of corpus vectors) that may hold neighbours."""
        between = _angle(pivots.supers @ pivots.supers.T)
        out = []
        for q, reach in widest.items():
            floor = self.floors[pivots.ends[q] : pivots.ends[q + 1]][np.isfinite(self.queries[pivots.ends[q] : pivots.ends[q + 1]])].max()
            out += [(int(q), int(c)) for c, width in held.items() if between[q, c] - reach - width <= floor + _SLACK]
        return out


def _distinct(vectors: DataFrame, published_only: bool, keep: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, key) of all usable rows; the ids of each key that can be listed; one row a key: vector, least id, how many.

    Equal vectors score alike against everything, so one of them stands for all. Of the copies only the smallest ids can
    be listed, and the window drops the others before the shuffle.
    """
    keyed = vectors.where(_usable("vector")).select("id", "vector", "published", F.sha2(F.to_json("vector"), 256).alias("key"))
    smallest = Window.partitionBy("key").orderBy("id")
    members = _corpus(keyed, published_only).select("key", "id").withColumn("_r", F.row_number().over(smallest))
    members = members.where(F.col("_r") <= keep).drop("_r")
    firsts = members.groupBy("key").agg(F.min("id").alias("first_id"), F.count("*").alias("w"))
    distinct = keyed.groupBy("key").agg(F.first("vector").alias("vector")).join(firsts, "key", "left")
    return keyed.select("id", "key"), members, cut_lineage(distinct)


def _listed(keyed: DataFrame, members: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``(source_id, id, rank, score)`` from candidates ``(q_key, c_key, first_id, score)``, one row for each pair of keys."""
    keep = k + 1
    by_score = Window.partitionBy("q_key").orderBy(F.desc("score"), "first_id")
    best = candidates.withColumn("_r", F.row_number().over(by_score)).where(F.col("_r") <= keep)
    by_id = Window.partitionBy("q_key").orderBy(F.desc("score"), "id")
    listed = best.join(members.withColumnRenamed("key", "c_key"), "c_key").withColumn("_r", F.row_number().over(by_id))
    lists = listed.where(F.col("_r") <= keep).groupBy("q_key").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), F.col("id")))).alias("near")
    )
    sources = keyed.select(F.col("id").alias("source_id"), F.col("key").alias("q_key")).join(lists, "q_key")
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("source_id")), 1, k)
    return sources.select("source_id", F.posexplode(others).alias("pos", "n")).select(
        "source_id", F.col("n.id").alias("id"), (F.col("pos") + 1).alias("rank"), (-F.col("n.neg")).alias("score")
    )


def _nothing(spark, id_type: str) -> DataFrame:
    return spark.createDataFrame([], f"source_id {id_type}, id {id_type}, rank int, score double")


_SCORED = ["q_key", "c_key", "first_id", "score"]


def _block_scores(q: pd.DataFrame, c: pd.DataFrame, keep: int) -> pd.DataFrame:
    """The ``keep`` best rows of ``c`` for each row of ``q``."""
    scores = _scores(_matrix(q["vector"]), _matrix(c["c_vector"]))
    picked = _best(scores, c["c_first_id"].to_numpy(), keep)
    flat = np.concatenate(picked)
    values = np.repeat(q["key"].to_numpy(), [len(p) for p in picked]), c["c_key"].to_numpy()[flat], c["c_first_id"].to_numpy()[flat]
    return pd.DataFrame(dict(zip(_SCORED, (*values, np.concatenate([scores[i, p] for i, p in enumerate(picked)])))))


def _packed_scores(q: dict, rows: np.ndarray, c: dict, others: np.ndarray, keep: int) -> Iterator[pd.DataFrame]:
    """One row for each of ``rows`` of ``q``: the ``keep`` best of ``others`` of ``c`` as lists."""
    matrix, ids, numbers = c["unit"][others], c["first_id"][others], c["no"][others]
    step = max(1, SCORES_HELD // len(others))
    for begin in range(0, len(rows), step):
        some = rows[begin : begin + step]
        scores = _scores(q["unit"][some], matrix)
        picked = _best(scores, ids, keep)
        lists = [numbers[p] for p in picked], [ids[p] for p in picked], [scores[i, p] for i, p in enumerate(picked)]
        yield pd.DataFrame(dict(zip(_SCORED, (q["no"][some], *lists))))


def similar_all(vectors: DataFrame, k: int = 5, published_only: bool = True, block_rows: int | None = None) -> DataFrame:
    """For every vector the ``k`` most similar others: ``(source_id, id, rank, score)``, exact.

    ``vectors`` carries ``id, vector, published``, vectors of one length. Scores are rounded to six places before ranking and
    ties go to the smaller id. The driver holds the pivots, as many as the square root of the distinct vectors. A super-block
    has at most about ``block_rows`` vectors, by default ``BLOCK_NUMBERS`` numbers.
    """
    spark = vectors.sparkSession
    keep = k + 1
    id_type = vectors.schema["id"].dataType.simpleString()
    keyed, members, distinct = _distinct(vectors, published_only, keep)
    total = distinct.count()
    if total == 0:
        return _nothing(spark, id_type)
    sample = distinct.select("vector").orderBy(F.xxhash64("vector"), "key").limit(int(np.ceil(np.sqrt(total)))).toPandas()
    unit = _matrix(sample["vector"])
    block_rows = block_rows or max(BLOCK_ROWS, BLOCK_NUMBERS // unit.shape[1])
    # Each first-level pivot may cost every vector a copy, so there are no more than their blocks or the tasks ask for.
    pivots = Pivots(unit, min(int(np.ceil(np.sqrt(len(unit)))), max(SUPERS, -(-total // block_rows))))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch.empty:
                best, wide, cell, narrow = pivots.place(_matrix(batch["vector"]))
                yield batch.assign(super=best.astype("int32"), wide=wide, cell=cell.astype("int32"), angle=narrow)

    # A number stands for a key from here on; both lie in the written copy.
    fields = f"no bigint, key string, vector {vectors.schema['vector'].dataType.simpleString()}, first_id {id_type}, w bigint"
    numbered = distinct.select(F.monotonically_increasing_id().alias("no"), "key", "vector", "first_id", "w")
    placed = cut_lineage(numbered.mapInPandas(assign, f"{fields}, super int, wide double, cell int, angle double"))

    in_corpus = F.col("first_id").isNotNull()
    corpus = placed.where(in_corpus)
    nearest_first = Window.partitionBy("cell").orderBy("angle", "key")
    nearest = corpus.withColumn("_r", F.row_number().over(nearest_first)).where(F.col("_r") <= keep).select("cell", "angle", "w").toPandas()
    cells = placed.groupBy("cell").agg(F.max("angle").alias("queries"), F.max(F.when(in_corpus, F.col("angle"))).alias("held")).toPandas()
    blocks = placed.groupBy("super").agg(
        F.max("wide").alias("queries"), F.max(F.when(in_corpus, F.col("wide"))).alias("held"), F.ceil(F.count("*") / block_rows).cast("int").alias("parts")
    ).collect()
    reach = Reach(pivots, cells, nearest, keep)
    pairs = set(reach.supers(pivots, {r["super"]: r["queries"] for r in blocks}, {r["super"]: r["held"] for r in blocks if r["held"] is not None}))
    parts = {r["super"]: r["parts"] for r in blocks}
    # One row for each side of each pair of first-level pivots, whose number is at most the fourth root of the vectors.
    sides = {(a, b, side) for a, b in ((min(p), max(p)) for p in pairs) for side in (0, 1) if side == 0 or a != b}
    met = [((a, b)[side], a, b, side, parts[(a, b)[1 - side]]) for a, b, side in sides]
    wanted = F.broadcast(spark.createDataFrame(met or [(-1, -1, -1, 0, 1)], "super int, a int, b int, side int, other_parts int"))
    own_parts = F.broadcast(spark.createDataFrame(sorted(parts.items()), "super int, parts int"))

    # The parts of one super meet each other and themselves: the lower one is the first side.
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    dealt = placed.join(own_parts, "super").withColumn("own", own).join(wanted, "super")
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
    first = (F.col("side") == 0) & ((F.col("a") != F.col("b")) | (F.col("own") <= F.col("other")))
    block = ["a", "b", "a_part", "b_part"]
    rows = dealt.select(
        "a",
        "b",
        F.when(first, F.col("own")).otherwise(F.col("other")).alias("a_part"),
        F.when(first, F.col("other")).otherwise(F.col("own")).alias("b_part"),
        F.when(first, 0).otherwise(1).alias("side"),
        "no",
        "cell",
        in_corpus.alias("held"),
        # Never NULL, as a column of numbers with NULLs loses digits on its way.
        F.coalesce("first_id", F.lit("0").cast(id_type)).alias("first_id"),
        "vector",
    )

    def score_blocks(both: pd.DataFrame) -> pd.DataFrame:
        a, b = int(both["a"].iloc[0]), int(both["b"].iloc[0])
        alone = a == b and int(both["a_part"].iloc[0]) == int(both["b_part"].iloc[0])
        held = {}
        for side, part in both.groupby("side"):
            columns = {c: part[c].to_numpy() for c in ("no", "cell", "held", "first_id")}
            held[side] = columns | {"unit": _matrix(part["vector"])}
        ways = [(0, 0)] if alone else [(q, c) for q, c in ((0, 1), (1, 0)) if ((a, b)[q], (a, b)[c]) in pairs]
        found = []
        for q, c in ways:
            if q not in held or c not in held:
                continue
            able = held[c]["held"].astype(bool)
            present = np.unique(held[c]["cell"][able])
            for cell in np.unique(held[q]["cell"]) if len(present) else ():
                others = np.flatnonzero(able & np.isin(held[c]["cell"], reach.cells(pivots, int(cell), present)))
                if len(others):
                    found += _packed_scores(held[q], np.flatnonzero(held[q]["cell"] == cell), held[c], others, keep)
        return pd.concat(found) if found else pd.DataFrame(columns=_SCORED)

    packed = f"q_key bigint, c_key array<bigint>, first_id array<{id_type}>, score array<double>"
    # A block is much work for its bytes, so blocks are not gathered in tasks by size.
    meetings = sum(parts[a] * (parts[a] + 1) // 2 if a == b else parts[a] * parts[b] for a, b in {(min(p), max(p)) for p in pairs})
    lists = rows.repartition(max(1, min(meetings, 4_096)), *block).groupBy(*block).applyInPandas(score_blocks, packed)
    # Dealt by query while still one row for each block, and taken apart behind the shuffle.
    scored = lists.repartition("q_key").select("q_key", F.inline(F.arrays_zip("c_key", "first_id", "score")))
    numbers = placed.select("key", "no")
    by_number = [df.join(numbers, "key").drop("key").withColumnRenamed("no", "key") for df in (keyed, members)]
    return _listed(*by_number, scored, k)


def plane_signs(length: int, first: int, count: int) -> np.ndarray:
    """Hyperplanes ``first`` to ``first + count``: each component is 1 or -1, by a rule that any engine can repeat."""
    p, d = np.arange(first, first + count)[:, None], np.arange(length)[None, :]
    a = (p * 7_919 + d * 104_729 + 12_345) % 1_000_003
    b = (a * a + 57 * a + 11) % 1_000_003
    return (b * b // 7 % 2 * 2 - 1).astype(np.float64)


def similar_lsh(
    vectors: DataFrame, k: int = 5, published_only: bool = True, tables: int = TABLES, planes: int = PLANES, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """For every vector the ``k`` most similar of those that share a bucket with it: ``(source_id, id, rank, score)``.

    A bucket holds the vectors on the same side of all ``planes`` random hyperplanes of one of ``tables`` tables, so two
    vectors at angle a share one with probability 1 - (1 - (1 - a / pi) ** planes) ** tables. A vector is copied once for
    each table and part of its bucket; a bucket of more than ``block_rows`` distinct vectors is dealt out in parts that
    meet each other, so none has to fit a task. Scores and ties as in ``similar_all``; vectors of one length.
    """
    keep = k + 1
    id_type = vectors.schema["id"].dataType.simpleString()
    vector_type = vectors.schema["vector"].dataType.simpleString()
    keyed, members, distinct = _distinct(vectors, published_only, keep)

    def sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            m = np.stack([np.asarray(v, dtype=np.float64) for v in batch["vector"]])
            above = m @ plane_signs(m.shape[1], 0, tables * planes).T > 0
            codes = above.reshape(len(m), tables, planes) @ (1 << np.arange(planes, dtype=np.int64))
            yield batch.assign(codes=list(codes))

    fields = f"key string, vector {vector_type}, first_id {id_type}, w bigint"
    hashed = cut_lineage(distinct.select("key", "vector", "first_id", "w").mapInPandas(sides, f"{fields}, codes array<bigint>"))
    met = hashed.select("key", "vector", "first_id", F.posexplode("codes").alias("table", "code"))
    # At most tables * 2 ** planes rows, whatever the number of vectors.
    sizes = hashed.select(F.posexplode("codes").alias("table", "code")).groupBy("table", "code").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    met = met.join(F.broadcast(sizes), ["table", "code"]).withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    block = ["table", "code", "q_part", "c_part"]
    q_side = met.withColumn("c_part", every).select(*block[:2], F.col("part").alias("q_part"), "c_part", "key", "vector")
    c_side = met.where(F.col("first_id").isNotNull()).withColumn("q_part", every).select(
        *block[:2], "q_part", F.col("part").alias("c_part"), F.col("key").alias("c_key"), F.col("vector").alias("c_vector"), F.col("first_id").alias("c_first_id")
    )

    def score_blocks(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return _block_scores(q, c, keep) if len(q) and len(c) else pd.DataFrame(columns=_SCORED)

    own = c_side.select(*[F.col(c).alias(f"{c}_") for c in block], "c_key", "c_vector", "c_first_id")
    scored = q_side.groupBy(*block).cogroup(own.groupBy(*[f"{c}_" for c in block])).applyInPandas(score_blocks, f"q_key string, c_key string, first_id {id_type}, score double")
    # A pair found in several tables counts once.
    return _listed(keyed, members, scored.dropDuplicates(["q_key", "c_key"]), k)
