"""Toxicity: a Levenshtein automaton run against a trie of toxic terms, and windows of context around each hit.

The lexicon holds a few general terms of abuse and what labelled texts add: words, and stems of four letters or
more, that are frequent in toxic texts and rare in clean ones. Words of a batch are matched together: a walk of the
trie carries, for every word still alive, the automaton's states as bit masks (bit i: i letters read) by number of
errors, so misspelled terms are found in one pass whatever the size of the lexicon. Each hit is weighed by the
window around it: quotation marks and words of reporting lower it, address and emphasis raise it. A logistic
regression over a document's hits gives the score.

Terms and regression are fitted on a bounded sample of labelled rows (``FIT_TOXIC``, ``FIT_CLEAN``), chosen by a hash
of the id; scoring covers every row and whole texts. Scoring is one pass of Arrow batches without a shuffle.

Defined results: NULL and empty texts have no hit and get the score of a text without hits. Rows without a label,
with a NULL label or a NULL id train nothing; a row labelled twice is toxic if one label says so. Without both
classes in the sample the general terms decide alone. Columns of the input are kept unless they bear the name of a
result; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe.llm.pieces import groups, in_small_batches

FIT_TOXIC, FIT_CLEAN = 4_000, 8_000
FOLDS = 5
STEM_LETTERS = range(4, 11)
# A term occurs in this many toxic texts, is this much likelier in them (log-odds by word) and beyond chance
# (log-likelihood ratio; high because many forms are tried). More labels let rarer terms pass.
LEAST_TEXTS, LEAST_ODDS, LEAST_EVIDENCE = 3, 2.5, 15.0
MOST_PER_TEXT = 5
# Words whose result a task remembers.
MOST_WORDS = 200_000
WINDOW = 60
LONGEST = 60
PARTS = 1_000_000

# General terms of abuse, words that report speech, and words of address.
GENERAL = "disgusting dumbass idiot imbecile loser moron pathetic retard scum scumbag stupid trash vermin worthless".split()
REPORTING = frozenset("quote quoted quotes said says word words term called wrote dijo dice palabra dit mot sagte wort".split())
ADDRESS = frozenset("you your youre u ur du dich dein tu te toi vous tú usted eres".split())
QUOTES = "\"“”„«»‘`"

WORD = re.compile(r"[^\W\d_]+")
FEATURES = ("any", "exact", "sum", "inexact", "quoted", "addressed", "distinct", "density", "length")


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool
    weight: float

    @property
    def budget(self) -> int:
        """Errors allowed: none in short terms, one from five letters, two from nine; stems take one from eight."""
        if self.stem:
            return int(len(self.text) >= 8)
        return 0 if len(self.text) < 5 else 1 if len(self.text) < 9 else 2


class Trie:
    """Terms as a trie, to be walked with the automata of many words at once."""

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most: list[int] = [0]
        for number, term in enumerate(terms):
            at = 0
            for letter in term.text:
                self.most[at] = max(self.most[at], term.budget)
                if letter not in self.children[at]:
                    self.children[at][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                at = self.children[at][letter]
            self.most[at] = max(self.most[at], term.budget)
            self.ends[at].append(number)

    def match(self, words: list[str]) -> dict[str, tuple[int, int]]:
        """For each word that matches, the term with fewest errors (then the heaviest) and its errors."""
        if not words:
            return {}
        codes = np.zeros((len(words), LONGEST), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for i, word in enumerate(words):
            head = np.frombuffer(word[:LONGEST].encode("utf-32-le", "surrogatepass"), np.uint32)
            codes[i, : len(head)] = head
        powers = np.uint64(1) << np.arange(LONGEST, dtype=np.uint64)
        letters = {c for level in self.children for c in level}
        masks = {c: ((codes == ord(c)) * powers).sum(1, dtype=np.uint64) for c in letters}
        one = np.uint64(1)
        full = np.uint64((1 << (LONGEST + 1)) - 1)
        end_bit = one << np.minimum(lengths, LONGEST).astype(np.uint64)
        whole = lengths <= LONGEST
        best: dict[str, tuple[int, float, int]] = {}

        def visit(node: int, alive: np.ndarray, states: list[np.ndarray]) -> None:
            for number in self.ends[node]:
                term = self.terms[number]
                for errors in range(term.budget + 1):
                    state = states[errors]
                    hit = state != 0 if term.stem else ((state & end_bit[alive]) != 0) & whole[alive]
                    for i in alive[hit].tolist():
                        found = (errors, -term.weight, number)
                        if words[i] not in best or found < best[words[i]]:
                            best[words[i]] = found
            for letter, child in self.children[node].items():
                mask = masks[letter][alive]
                after = []
                for e in range(self.most[child] + 1):
                    state = ((states[e] & mask) << one) & full
                    if e:
                        state |= states[e - 1] | ((states[e - 1] | after[e - 1]) << one) & full
                    after.append(state)
                # A state beyond a word's end stands for letters that are not there.
                reach = (end_bit[alive] << one) - one
                after = [s & reach for s in after]
                live = np.flatnonzero(np.bitwise_or.reduce(after) != 0)
                if len(live):
                    visit(child, alive[live], [s[live] for s in after])

        # Before the first letter of the trie, e letters of the word may have been skipped.
        start = [np.full(len(words), (1 << (e + 1)) - 1, np.uint64) for e in range(max(self.most) + 1)]
        visit(0, np.arange(len(words)), start)
        return {word: (number, errors) for word, (errors, _, number) in best.items()}


class Scorer:
    """Features of texts; remembers which words matched."""

    def __init__(self, terms: list[Term]):
        self.trie = Trie(terms)
        self.found: dict[str, tuple[int, int]] = {}
        self.seen: set[str] = set()

    def features(self, texts: list[str]) -> np.ndarray:
        if len(self.seen) > MOST_WORDS:
            self.seen, self.found = set(), {}
        lowered = [t.lower() for t in texts]
        words = [WORD.findall(t) for t in lowered]
        new = list({w for ws in words for w in ws}.difference(self.seen))
        self.seen.update(new)
        for begin in range(0, len(new), 20_000):
            self.found.update(self.trie.match(new[begin : begin + 20_000]))
        out = np.zeros((len(texts), len(FEATURES)))
        if self.found:
            for i, ws in enumerate(words):
                if not self.found.keys().isdisjoint(ws):
                    out[i] = self._document(lowered[i], len(ws))
        return out

    def _document(self, text: str, n_words: int) -> np.ndarray:
        exact = inexact = quoted = addressed = weight = 0.0
        terms = set()
        for m in WORD.finditer(text):
            hit = self.found.get(m[0])
            if hit is None:
                continue
            term, errors = self.trie.terms[hit[0]], hit[1]
            before, after = text[max(0, m.start() - WINDOW) : m.start()], text[m.end() : m.end() + WINDOW]
            near = {*WORD.findall(before)[-6:], *WORD.findall(after)[:6]}
            inside = before[-1:] in QUOTES and before[-1:] and after[:1] in QUOTES
            reported = bool(inside) or sum(before.count(q) for q in QUOTES) % 2 == 1 and any(q in after for q in QUOTES) or bool(near & REPORTING)
            direct = bool(near & ADDRESS) or "!" in after[:20]
            value = term.weight * (0.25 if reported else 1.5 if direct else 1.0)
            if errors:
                inexact += value / errors
            else:
                exact += value
            quoted += reported
            addressed += direct and not reported
            weight += value
            terms.add(hit[0])
        logs = map(np.log1p, (inexact, quoted, addressed, len(terms), 100 * weight / max(n_words, 1), n_words))
        return np.array([1.0, np.log1p(exact), min(weight, 50.0) / 10, *logs])


@dataclass(frozen=True)
class Model:
    terms: tuple[Term, ...]
    weights: tuple[float, ...]
    bias: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.weights) + self.bias, -30, 30)))


def held_out(key) -> F.Column:
    """True for the rows that never train."""
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, toxic: str) -> DataFrame:
    """(text, toxic) of the sample. Its ids are bounded by the two limits, up to the chance of the hash, and broadcast."""
    known = labels.where(F.col(key).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(key).alias("_id")).agg((F.max(toxic) > 0).alias("toxic"))
    known = known.where(~held_out(F.col("_id")))
    n = known.agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c")).first()
    part = F.pmod(F.xxhash64("_id"), F.lit(PARTS))
    least = F.when(F.col("toxic"), min(PARTS, PARTS * FIT_TOXIC // max(n["t"], 1))).otherwise(min(PARTS, PARTS * FIT_CLEAN // max(n["c"], 1)))
    sample = known.where(part < least)
    found = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return found.join(F.broadcast(sample), "_id").select("text", F.col("toxic").cast("int").alias("toxic")).distinct()


def learn_terms(rows: DataFrame) -> list[Term]:
    """Words and stems of the sample's toxic texts that are rare in clean ones. Spark judges the forms; only those that
    pass reach the driver, at most the words of ``FIT_TOXIC`` texts. Uses in one text count up to ``MOST_PER_TEXT``."""

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts: Counter[str] = Counter()
                for word in WORD.findall(text.lower()):
                    counts.update([word, *(word[:n] + "*" for n in STEM_LETTERS if len(word) >= n)])
                every = [f for f in counts if len(f) <= LONGEST]
                uses = [min(counts[f], MOST_PER_TEXT) for f in every]
                columns = [pa.array(every, pa.string()), pa.array([toxic] * len(every), pa.int32()), pa.array(uses, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["form", "toxic", "uses"])

    words = F.size(F.split("text", r"\s+"))
    totals = rows.groupBy("toxic").agg(F.count("*").alias("texts"), F.sum(words).alias("words")).collect()
    texts, size = {r["toxic"]: r["texts"] for r in totals}, {r["toxic"]: r["words"] for r in totals}
    if set(texts) != {0, 1}:
        return []
    toxic_uses, clean_uses = F.sum(F.when(F.col("toxic") == 1, F.col("uses")).otherwise(0)), F.sum(F.when(F.col("toxic") == 0, F.col("uses")).otherwise(0))
    counts = in_small_batches(rows).mapInArrow(forms, "form string, toxic int, uses bigint").groupBy("form")
    counts = counts.agg(F.sum("toxic").alias("texts"), toxic_uses.alias("t"), clean_uses.alias("c"))
    share = size[1] / (size[0] + size[1])
    t, c = F.col("t"), F.col("c")
    odds = F.log((t + 0.5) / size[1]) - F.log((c + 0.5) / size[0])
    of_clean = F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
    judged = counts.where(F.col("texts") >= LEAST_TEXTS).withColumns({"odds": odds, "evidence": t * F.log(t / ((t + c) * share)) + of_clean})
    passed = judged.where((F.col("odds") >= LEAST_ODDS) & (F.col("evidence") >= LEAST_EVIDENCE)).select("form", "texts", "odds").collect()
    return narrowed({r["form"]: (r["texts"], r["odds"]) for r in passed})


def _stems(text: str) -> list[str]:
    return [text[:n] for n in STEM_LETTERS if n <= len(text)]


def narrowed(found: dict[str, tuple[int, float]]) -> list[Term]:
    """Each family of forms by its most telling members: a stem gives way to a longer form that holds nearly all its
    texts, and a longer form gives way to a stem that is left, unless it tells clearly more."""
    given_way = set()
    for form, (texts, _) in found.items():
        above = (s + "*" for s in _stems(form.rstrip("*")))
        given_way |= {s for s in above if s != form and s in found and texts >= 0.95 * found[s][0]}
    kept = {form: found[form] for form in found if form not in given_way}
    stems = {f[:-1]: odds for f, (_, odds) in kept.items() if f.endswith("*")}

    def told(form: str, odds: float) -> bool:
        return any(s in stems and form != s + "*" and odds < stems[s] + 2 for s in _stems(form.rstrip("*")))

    return [Term(f.rstrip("*"), f.endswith("*"), odds) for f, (_, odds) in sorted(kept.items()) if not told(f, odds)]


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method, both classes weighing alike."""
    design = np.column_stack([x, np.ones(len(x))])
    share = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (share * (p - y)) + penalty @ w
        step = np.linalg.solve((design * (share * p * (1 - p))[:, None]).T @ design + penalty, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """Terms and regression from the labelled rows that are not held out."""
    rows = training_rows(docs, labels, key, text, toxic).persist()
    try:
        learnt = {t.text: t for t in learn_terms(rows)}
        mean = float(np.mean([t.weight for t in learnt.values()])) if learnt else LEAST_ODDS
        stems = [t.text for t in learnt.values() if t.stem]
        general = [Term(w, False, mean) for w in GENERAL if w not in learnt and not any(w.startswith(s) for s in stems)]
        terms = (*learnt.values(), *general)
        found = with_features(rows, terms, "text").select("toxic", "features").toPandas()
    finally:
        rows.unpersist()
    y = found["toxic"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return Model(terms, (1.0, 1.0, 0.0, 0.3, -0.3, 0.3, 0.3, 0.3, -0.3), -2.0)
    weights, bias = regression(np.array(found["features"].tolist(), float), y)
    return Model(terms, tuple(map(float, weights)), bias)


def _per_text(df: DataFrame, terms: tuple[Term, ...], text: str, fields: list[T.StructField], give) -> DataFrame:
    kept = df.drop(*[f.name for f in fields])
    schema = T.StructType([*kept.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(list(terms))
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for first, last in groups(map(len, texts)):
                columns = [*batch.slice(first, last - first).columns, *give(scorer.features(texts[first:last]))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *[f.name for f in fields]])

    return in_small_batches(kept).mapInArrow(run, schema)


def with_features(df: DataFrame, terms: tuple[Term, ...], text: str) -> DataFrame:
    fields = [T.StructField("features", T.ArrayType(T.DoubleType()))]
    return _per_text(df, terms, text, fields, lambda x: [pa.array(x.tolist(), pa.list_(pa.float64()))])


def score(docs: DataFrame, model: Model, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), under the names given."""
    fields = [T.StructField(score, T.DoubleType()), T.StructField(predicted, T.IntegerType())]

    def give(features: np.ndarray) -> list[pa.Array]:
        scores = model.scores(features)
        return [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))]

    return _per_text(docs, model.terms, text, fields, give)
