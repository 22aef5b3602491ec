"""Token ids of texts by way of their distinct pieces: each worker encodes a piece once and gathers ids in bulk."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# A store is emptied between groups of texts when its pieces or ids exceed this, so a worker's memory is bounded.
MAX_PIECES, MAX_IDS = 250_000, 4_000_000
GROUP_CHARACTERS = 1_000_000
# Rows of an Arrow batch. The session's default of 10,000 suits numbers; texts and vectors are a thousand times as wide.
BATCH_ROWS = 1_000


class PieceStore:
    """Pieces and their ids in one flat array. ``encode`` gets distinct new pieces, gives (flat ids, counts)."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = MAX_PIECES):
        self._encode, self._most = encode, most
        self._clear()

    def _clear(self) -> None:
        self._code: dict[str, int] = {}
        self._ids = np.zeros(0, np.int32)
        self._starts = np.zeros(1, np.int64)

    def codes(self, pieces: pa.Array) -> np.ndarray:
        """The store's number of each piece, after encoding those that are new."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        code = self._code
        new = [p for p in distinct if p not in code]
        if new:
            flat, counts = self._encode(new)
            code.update(zip(new, range(len(code), len(code) + len(new))))
            self._ids = np.concatenate([self._ids, flat.astype(np.int32)])
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(counts)])
        known = np.fromiter(map(code.__getitem__, distinct), np.int64, len(distinct))
        return known[coded.indices.to_numpy()]

    def gather(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of texts, given as the codes of all their pieces and each text's number of them, and its number of
        ids. A full store is emptied afterwards: codes do not outlive the call."""
        begin, count = self._starts[codes], self._starts[codes + 1] - self._starts[codes]
        ends = np.cumsum(count)
        places = np.repeat(begin - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        ids = self._ids[places]
        if len(self._code) > self._most or len(self._ids) > MAX_IDS:
            self._clear()
        return ids, np.diff(edges)


def groups(lengths: Iterable[int], limit: int = GROUP_CHARACTERS) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of consecutive texts with about ``limit`` characters in all; ``last`` is exclusive."""
    first = size = i = 0
    for i, length in enumerate(lengths, 1):
        size += length
        if size >= limit:
            yield first, i
            first, size = i, 0
    if first < i:
        yield first, i


def wide_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches as one while ``column`` holds about ``limit`` bytes in all. At most that and a batch is held."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df`` itself; from now on its session hands Python batches of ``BATCH_ROWS`` rows at most."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)
    return df
