"""Merkle fingerprints against plain Python, equality by roots, edits located, successors around the end."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import fingerprints


def corpus(seed=2, count=120):
    rng = random.Random(seed)
    words = ["alpha", "béta,", "gamma.", "漢字", "x|y", "😀", "end!?", "a" * 150, ";", ""]
    texts = []
    for _ in range(count):
        lines = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(rng.randint(1, 6))]
        texts.append(rng.choice(["\n", "\n\n"]).join(lines))
    return texts + ["", "\n", "\n\n", "\n\n\n", " ", texts[0], "long " * 60_000]


def plain(text):
    """(root, pieces) by going through the text once more in another way."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    tops, pieces = "", []
    for section in text.split("\n\n"):
        inner = ""
        for line in section.split("\n"):
            own, i = [], 0
            while i < len(line):
                j = i
                while j < len(line) and j - i < 64 and line[j] not in ".,;:!?|":
                    j += 1
                while j < len(line) and line[j] in ".,;:!?|":
                    j += 1
                own.append(md5(line[i:j]))
                i = j
            inner += md5("".join(own))
            pieces += own
        tops += md5(inner)
    return md5(tops), Counter(p[:8] for p in pieces)


def test_tree_and_likeness_equal_plain_python():
    texts = corpus()
    for left in texts[::5] + texts[-7:]:
        assert fingerprints.fingerprint(left).split("|")[0] == plain(left)[0]
        for right in texts[::7] + texts[-7:]:
            a, b = plain(left)[1], plain(right)[1]
            whole = sum(a.values()) + sum(b.values())
            want = 2 * sum((a & b).values()) / whole if whole else 1.0
            assert fingerprints.likeness(*map(fingerprints.fingerprint, (left, right))) == want


def test_equal_roots_mean_equal_texts():
    texts = corpus()
    roots = {}
    for t in texts:
        assert roots.setdefault(fingerprints.fingerprint(t).split("|")[0], t) == t
    assert len(roots) == len(set(texts))
    assert fingerprints.fingerprint(None) == fingerprints.fingerprint("")


def test_differing_branches_locate_an_edit():
    sections = [[f"line {s} {p}, with words." for p in range(4)] for s in range(5)]
    text = "\n\n".join("\n".join(s) for s in sections)
    sections[3][2] = "line 3 2, with other words."
    edited = "\n\n".join("\n".join(s) for s in sections)
    a, b = map(fingerprints.fingerprint, (text, edited))
    mine, theirs = fingerprints.differing(a, b)
    assert [p[:2] for p in mine] == [p[:2] for p in theirs] == [(4, 3)]
    score, place = fingerprints.compare(a, b)
    assert place == "4.3" and 0.9 < score < 1
    assert fingerprints.compare(a, a) == (1.0, None) and fingerprints.compare(a, None) == (0.0, None)


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_next_text_goes_around(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.randrange(-40, 60), t) for t in corpus(ranges, 60)] + [(None, "z"), (None, None), (7, "tie"), (7, "tie"), (7, None)] + [(5, "hot")] * 60
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("place", F.lit("clash")).repartition(6)
    found = [tuple(r) for r in fingerprints.with_next(frame, ranges=ranges).collect()]
    marks = dict(spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", F.xxhash64("t")).collect())
    ordered = sorted(((k is not None, k or 0, marks[t or ""], t or "") for k, t in rows))
    want = [((k if filled else None), t, ordered[(i + 1) % len(ordered)][3]) for i, (filled, k, _, t) in enumerate(ordered)]
    assert Counter(found) == Counter(want)


def test_single_and_no_rows(spark):
    one = spark.createDataFrame([(3, "only")], "doc_id bigint, text string")
    assert [tuple(r) for r in fingerprints.with_next(one).collect()] == [(3, "only", "only")]
    assert fingerprints.with_next(one.limit(0)).collect() == []
    assert fingerprints.with_fingerprints(one.limit(0), {"text": "print"}).collect() == []


def test_columns_of_rows(spark):
    frame = spark.createDataFrame([(1, "a, b.\nc", "a, b.\nd"), (2, None, ""), (2, "x", "x")], "n int, t string, u string")
    rows = fingerprints.with_likeness(fingerprints.with_fingerprints(frame, {"t": "p", "u": "q"}), "p", {"q": ("near", "at")}).collect()
    assert [(r["n"], r["near"], r["at"]) for r in rows] == [(1, 4 / 6, "1.2"), (2, 1.0, None), (2, 1.0, None)]
    assert all(r["p"] == fingerprints.fingerprint(r["t"]) for r in rows)
