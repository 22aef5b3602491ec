"""Secret scan through trigram queries over an inverted index, verified by the regexes themselves.

Each rule's Boolean trigram query is derived from its parsed regex: an AND over clauses, each an OR over texts one of
which every match contains, each of these the AND of its trigrams. Concatenated parts of few texts (letters, small
classes, alternatives, optional parts) are multiplied out; a part of many or unboundedly many texts ends a clause.
A document is one shard of the index: it is cut into overlapping blocks, and its postings map each trigram that any
rule asks for to the blocks that hold it. Postings of a text's trigrams are intersected, those of a clause's texts
united; a rule with a clause whose result is empty cannot match and its regex does not run. A rule without a clause
(runs of hex digits) scans every text. Because a shard never leaves its row, nothing is shuffled and no posting list
grows with the corpus. ``postings`` gives the same index as rows.

DataFrame functions only. Verification runs over the whole text, so a match may cross blocks: blocks overlap by the
longest text of a clause, which is all that the index looks for. Places are running sums made in runs of the square
root of the number of matches, so that a text of many matches takes no time quadratic in them.

Defined results: a NULL or empty text has no span. Repeated rows are scanned alike. An empty table gives none. Columns
of the input are kept unless they bear the name of a result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field
from re import _constants as kinds
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
# Texts that a part of a regex may stand for before it ends a clause.
MOST_TEXTS = 64
TRIGRAM = 3


@dataclass(frozen=True)
class Rule:
    """``pattern`` in syntax common to Java and Python, with case folded for ASCII at most; a match is dropped unless
    ``least`` (group, characters), the least length of that group, holds."""

    kind: str
    pattern: str
    least: tuple[int, int] = field(default=(0, 0))

    @functools.cached_property
    def clauses(self) -> tuple[tuple[str, ...], ...]:
        """For each clause the lower-case texts one of which every match contains."""
        texts, clauses = _concatenation(parser.parse(self.pattern))
        found = {tuple(sorted(c)) for c in clauses + ([_shortest(texts)] if texts else []) if _long(c)}
        return tuple(sorted(found))

    def query(self) -> tuple[tuple[tuple[str, ...], ...], ...]:
        """The Boolean trigram query: a conjunction of alternatives of conjunctions."""
        return tuple(tuple(tuple(sorted({t[i : i + TRIGRAM] for i in range(len(t) - TRIGRAM + 1)})) for t in clause) for clause in self.clauses)


# What a part of a regex stands for: all its texts, or None if they are many, and the clauses that hold besides.
Part = tuple[set[str] | None, list[set[str]]]


def _shortest(texts: set[str]) -> set[str]:
    """``texts`` without those that contain another one."""
    return {t for t in texts if not any(o != t and o in t for o in texts)}


def _long(clause: set[str]) -> bool:
    return bool(clause) and min(map(len, clause)) >= TRIGRAM


def _concatenation(items) -> Part:
    run, whole, clauses = {""}, True, []
    for item in items:
        texts, inner = _part(*item)
        clauses += inner
        if texts is not None and len(run) * len(texts) <= MOST_TEXTS:
            run = {a + b for a in run for b in texts}
        else:
            clauses.append(_shortest(run))
            run, whole = texts or {""}, False
    return (run, []) if whole else (None, [c for c in [*clauses, _shortest(run)] if _long(c)])


def _part(kind, value) -> Part:
    if kind is kinds.LITERAL:
        return ({chr(value).lower()}, []) if value < 128 else (None, [])
    if kind is kinds.IN:
        codes = {c for k, v in value if k in (kinds.LITERAL, kinds.RANGE) for c in ([v] if k is kinds.LITERAL else range(v[0], v[1] + 1))}
        known = all(k in (kinds.LITERAL, kinds.RANGE) for k, _ in value) and max(codes) < 128
        texts = {chr(c).lower() for c in codes} if known else None
        return (texts if texts and len(texts) <= MOST_TEXTS else None), []
    if kind in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
        return {""}, []
    if kind is kinds.SUBPATTERN:
        return _concatenation(value[3])
    if kind is kinds.BRANCH:
        branches = [_concatenation(b) for b in value[1]]
        if all(texts is not None for texts, _ in branches):
            every = set().union(*(texts for texts, _ in branches))
            return (every, []) if len(every) <= MOST_TEXTS else (None, [_shortest(every)])
        offers = [[c for c in (clauses if texts is None else [_shortest(texts)]) if _long(c)] for texts, clauses in branches]
        return None, [set().union(*(max(o, key=lambda c: min(map(len, c))) for o in offers))] if all(offers) else []
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        least, most, body = value
        texts, clauses = _concatenation(body)
        if least == 0:
            return (texts | {""} if texts is not None and most == 1 else None), []
        if texts is None:
            return None, clauses
        times = max((n for n in range(1, min(least, MOST_TEXTS) + 1) if len(texts) ** n <= MOST_TEXTS), default=0)
        repeated = functools.reduce(lambda left, _: {a + b for a in left for b in texts}, range(times), {""})
        return (repeated, []) if times == least == most else (None, [_shortest(repeated)])
    return None, []


# Kinds in the order of the base rules: the keywords are matched in either case, their letters being ASCII.
ASSIGN = Rule(
    "assign",
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    (2, 6),
)
ACCESS = Rule("access", "AKIA[A-Z0-9]+", (0, 20))
HEX = Rule("hex", "[0-9a-f]{24,}")
BASE = (ASSIGN, ACCESS, HEX)
ADDED = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + ADDED


def trigrams(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for rule in rules for clause in rule.query() for text in clause for t in text})


def blocks(text: Column, rules: tuple[Rule, ...], size: int = BLOCK) -> Column:
    """The lower-cased text in blocks of ``size`` code points, each with as much of the next as the longest text of a clause."""
    more = max((len(t) for rule in rules for clause in rule.clauses for t in clause), default=1) - 1
    pattern = F.lit(f"(?s)(?=(.{{1,{size + more}}})).{{1,{size}}}")
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), pattern, F.lit(1))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shard(parts: Column, rules: tuple[Rule, ...]) -> Column:
    """Postings in the order of ``trigrams(rules)``: for each the numbers of the blocks that hold it."""
    wanted = F.array(*[F.lit(t) for t in trigrams(rules)])
    numbered = F.transform(parts, lambda part, i: F.struct(i.alias("i"), part.alias("part")))

    def posting(t: Column, blocks: Column) -> Column:
        return F.transform(F.filter(blocks, lambda b: F.contains(b.part, t)), lambda b: b.i)

    return _bound(numbered, lambda held: F.transform(wanted, lambda t: posting(t, held)))


def candidate_blocks(index: Column, clause: tuple[tuple[str, ...], ...], place: dict[str, int]) -> Column:
    """Blocks that hold all trigrams of a text of the clause: intersected postings of each text, united over the texts."""
    found = F.array().cast("array<int>")
    for grams in clause:
        common = F.get(index, F.lit(place[grams[0]]))
        for t in grams[1:]:
            common = F.array_intersect(common, F.get(index, F.lit(place[t])))
        found = F.array_union(found, common)
    return found


def candidates(text: Column, rules: tuple[Rule, ...]) -> Column:
    """For each rule whether its regex must run: every clause has a block, of which a match may touch several."""
    place = {t: i for i, t in enumerate(trigrams(rules))}

    def asked(index: Column) -> Column:
        met = [[F.size(candidate_blocks(index, clause, place)) > 0 for clause in rule.query()] for rule in rules]
        return F.array(*[functools.reduce(Column.__and__, clauses, F.lit(True)) for clauses in met])

    return _bound(shard(blocks(text, rules), rules), asked)


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index as rows: (trigram, key, blocks), without empty postings."""
    wanted = trigrams(rules)
    rows = docs.select(F.col(key).alias(key), F.posexplode(shard(blocks(F.col(text), rules), rules)).alias("i", "blocks"))
    named = F.element_at(F.array(*[F.lit(t) for t in wanted]), F.col("i") + 1)
    return rows.where(F.size("blocks") > 0).select(named.alias("trigram"), key, "blocks")


def _in_runs(values: Column) -> Column:
    """``values`` in runs as long as the square root of their number; one empty run of none."""

    def cut(held: Column) -> Column:
        length = F.greatest(F.ceil(F.sqrt(F.size(held))).cast("int"), F.lit(1))
        last = F.floor((F.greatest(F.size(held), F.lit(1)) - 1) / length).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(held, k * length + 1, length))

    return _bound(values, cut)


def _before(runs: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each run what ``join`` makes of 0 and all values before each place of it and, last, before its end.

    Appending copies an array: here one of a run or one of an entry for each run.
    """
    zero = F.array(F.lit(0))

    def along(values: Column) -> Column:
        return F.aggregate(values, zero, lambda done, v: F.array_append(done, join(F.element_at(done, -1), v)))

    def put(inner: Column) -> Column:
        heads = F.aggregate(inner, zero, lambda done, run: F.array_append(done, join(F.element_at(done, -1), F.element_at(run, -1))))
        return _bound(heads, lambda h: F.transform(inner, lambda run, k: F.transform(run, lambda v: join(F.get(h, k), v))))

    return _bound(F.transform(runs, along), put)


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """Lengths that make up a text: those of its matches, leftmost and non-overlapping, of the least group in each, and
    of the pieces before, between and behind the matches."""
    whole = F.coalesce(text, F.lit(""))
    lengths = lambda group: F.transform(F.regexp_extract_all(whole, F.lit(rule.pattern), F.lit(group)), F.length)
    gaps = F.transform(F.split(whole, rule.pattern, -1), F.length)
    parts = lengths(rule.least[0]) if rule.least[0] else F.lit(None).cast("array<int>")
    given = {"kind": F.lit(rule.kind), "rank": F.lit(rank), "least": F.lit(rule.least[1]), "gaps": gaps, "sizes": lengths(0), "parts": parts}
    return F.struct(*[c.alias(name) for name, c in given.items()])


def long_spans(found: Column) -> Column:
    """Spans (start, rank, kind, end) of the ``matches`` that are long enough; code points, end exclusive."""
    widths = F.transform(found.sizes, lambda size, i: size + F.get(found.gaps, i))
    ends = F.flatten(F.transform(_before(_in_runs(widths), lambda a, b: a + b), lambda run: F.slice(run, 2, F.size(run))))

    def at(ends: Column) -> Column:
        def span(size: Column, i: Column) -> Column:
            end, part = F.get(ends, i), F.coalesce(F.get(found.parts, i), size)
            given = {"start": end - size, "rank": found["rank"], "kind": found.kind, "end": end}
            return F.when(part >= found.least, F.struct(*[c.alias(name) for name, c in given.items()]))

        return F.filter(F.transform(found.sizes, span), lambda s: s.isNotNull())

    return _bound(ends, at)


def find_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, secrets: str = "secrets") -> DataFrame:
    """``docs`` with ``secrets``: spans of all rules by start, then in the order of ``rules``."""
    asked = "_asked"
    while asked in docs.columns:
        asked += "_"
    tried = F.array(*[F.when(F.get(asked, F.lit(i)), matches(F.col(text), rule, i)) for i, rule in enumerate(rules)])
    found = F.sort_array(F.flatten(F.transform(F.filter(tried, lambda m: m.isNotNull()), long_spans)))
    spans = F.transform(found, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    return docs.drop(secrets).withColumn(asked, candidates(F.col(text), rules)).withColumn(secrets, spans).drop(asked)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """``text`` with every span, overlapping ones as one, replaced by ``mark``. ``spans`` are ordered by start.

    A run of spans cuts its own stretch of the text, so that the whole text is passed over once for each run.
    """

    def stretch(run: Column, reached: Column) -> Column:
        begin = F.element_at(reached, 1)
        own = F.substring(text, begin + 1, F.element_at(reached, -1) - begin)

        def pieces(own: Column) -> Column:
            def piece(s: Column, i: Column) -> Column:
                at = F.get(reached, i)
                gap = F.substring(own, at - begin + 1, s.start - at)
                return F.when(s.start >= at, F.concat(gap, F.lit(mark))).otherwise("")

            return F.array_join(F.transform(run, piece), "")

        return _bound(own, pieces)

    def masked(runs: Column) -> Column:
        ends = F.transform(runs, lambda run: F.transform(run, lambda s: s.end))

        def joined(reached: Column) -> Column:
            parts = F.zip_with(runs, reached, stretch)
            rest = F.substring(text, F.element_at(F.element_at(reached, -1), -1) + 1, F.length(text))
            return F.concat(F.array_join(parts, ""), rest)

        return _bound(_before(ends, F.greatest), joined)

    return F.when(F.size(spans) > 0, _bound(_in_runs(spans), masked)).otherwise(text)
