"""License scan: MinHash bands over overlapping windows of a text retrieve templates, containment verifies them.

A template of L words is looked for in windows of L words that start every L/8 words (every word for short ones), so
some window covers all but a sixteenth of it. Window and template meet if one band of their MinHash signatures of
three-word shingles agrees. A match holds at least ``CONTAINMENT`` of the template's shingles; in a window as long as
the template that is a Jaccard similarity of 0.6 or more, at which ``BANDS`` bands of two values miss with a
probability below one in a million. Candidates are verified by exact containment of word shingles in the window and
its surroundings.

A band can agree only if the window holds a shingle of a template, so windows without one need no signature.

Style: Arrow batches in the tasks, without a shuffle; templates are a fixed list that travels with the code.

Defined results: NULL and empty texts match nothing. Matches of one template that overlap are one row, the best;
different templates may overlap. Repeated documents are reported each. Words are runs of ASCII letters and digits in
lower case. Only the named columns are read and returned.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.pieces import groups, in_small_batches

SHINGLE, CONTAINMENT = 3, 0.8
ROWS, BANDS = 2, 31
SEED = 13
WORD = re.compile("[a-z0-9]+")
BREAK = "[^a-z0-9]+"

# License notices and texts as their publishers word them.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("all-rights-reserved", "All rights reserved"),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "mit",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
)

MATCH = "license string, template int, start bigint, end bigint, containment double"


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, SEED) for w in words), np.uint64, len(words))


def _shingle_hashes(words: np.ndarray) -> np.ndarray:
    total = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(total)]
    total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        rng = np.random.default_rng(SEED)
        self.a = rng.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint32)
        self.templates = [(name, WORD.findall(text.lower())) for name, text in templates]
        if any(len(words) < SHINGLE for _, words in self.templates):
            raise ValueError(f"a template needs {SHINGLE} words")
        self.shingles = [shingles(words) for _, words in self.templates]
        self.bands: dict[tuple[int, bytes], set[int]] = defaultdict(set)
        self.lengths: dict[int, list[int]] = defaultdict(list)
        every = []
        for number, (_, words) in enumerate(self.templates):
            grams = _shingle_hashes(_hashes(words))
            every.append(grams)
            self.lengths[len(words)].append(number)
            for band in self.signature(grams):
                self.bands[band].add(number)
        self.known = np.unique(np.concatenate(every))

    def signature(self, grams: np.ndarray) -> list[tuple[int, bytes]]:
        least = ((grams >> np.uint64(32)).astype(np.uint32)[None, :] * self.a + self.b).min(1)
        return [(k, row.tobytes()) for k, row in enumerate(least.reshape(BANDS, ROWS))]

    def holds_known(self, grams: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        return self.known[place] == grams

    def candidates(self, grams: np.ndarray, known: np.ndarray) -> set[tuple[int, int]]:
        """(template, first word) of the windows that share a band with a template of their length."""
        found = set()
        before = np.concatenate([[0], np.cumsum(known)])
        for length, numbers in self.lengths.items():
            width, step = length - SHINGLE + 1, max(1, length // 8)
            last = max(0, len(grams) - width)
            starts = np.unique(np.append(np.arange(0, last + 1, step), last))
            for start in starts[before[np.minimum(starts + width, len(grams))] > before[starts]].tolist():
                met = set().union(*(self.bands.get(band, ()) for band in self.signature(grams[start : start + width])))
                found |= {(n, start) for n in met.intersection(numbers)}
        return found

    def scan(self, text: str, grams: np.ndarray, known: np.ndarray) -> list[tuple[str, int, int, int, float]]:
        """Matches of one text with places in code points."""
        found = self.candidates(grams, known)
        if not found:
            return []
        places = [(m.start(), m.end(), m[0]) for m in WORD.finditer(_lower(text))]
        best: dict[int, list[tuple[float, int, int]]] = defaultdict(list)
        for number, start in sorted(found):
            length = len(self.templates[number][1])
            slack = max(1, length // 8)
            first, last = max(0, start - slack), min(len(places), start + length + slack)
            wanted = self.shingles[number]
            hits = [i for i in range(first, last - SHINGLE + 1) if tuple(w for _, _, w in places[i : i + SHINGLE]) in wanted]
            held = {tuple(w for _, _, w in places[i : i + SHINGLE]) for i in hits}
            share = len(held) / len(wanted)
            if share < CONTAINMENT:
                continue
            span = (share, places[hits[0]][0], places[hits[-1] + SHINGLE - 1][1])
            over = [s for s in best[number] if s[1] < span[2] and span[1] < s[2]]
            if all((span[0], -span[2] + span[1]) > (s[0], -s[2] + s[1]) for s in over):
                best[number] = [s for s in best[number] if s not in over] + [span]
        rows = [(self.templates[n][0], n, a, b, share) for n, spans in best.items() for share, a, b in spans]
        return sorted(rows, key=lambda r: (r[2], r[1]))


def _lower(text: str) -> str:
    """ASCII letters in lower case, everything else as it is, so that places stay."""
    return text.translate(_FOLD)


_FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def find_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(key, license, template, start, end, containment): a row for each match."""
    source = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            texts = batch.column("text")
            for first, last in groups(pc.binary_length(texts).to_pylist()):
                part, keys = texts.slice(first, last - first), batch.column("key").slice(first, last - first)
                cut = pc.split_pattern_regex(pc.ascii_lower(part), BREAK)
                words, of = cut.flatten(), pc.list_parent_indices(cut)
                filled = pc.not_equal(words, "")
                coded, of = words.filter(filled).dictionary_encode(), of.filter(filled).to_numpy()
                hashes = _hashes(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
                grams = _shingle_hashes(hashes)
                # A run of words that crosses into the next text is no shingle.
                inside = of[: len(grams)] == of[SHINGLE - 1 :]
                known = scanner.holds_known(grams) & inside
                edges = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(part)))])
                out = []
                for i in np.unique(of[: len(grams)][known]).tolist():
                    a, b = edges[i], edges[i + 1] - SHINGLE + 1
                    out += [(keys[i].as_py(), *row) for row in scanner.scan(part[i].as_py(), grams[a:b], known[a:b])]
                if out:
                    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
                    names = ["key", "license", "template", "start", "end", "containment"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return in_small_batches(source).mapInArrow(run, f"key bigint, {MATCH}").withColumnRenamed("key", key)
