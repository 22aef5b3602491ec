"""URL filter: rules first, then the ratio of two character language models.

Accepted and rejected URLs (those that a rule decides) each train a smoothed variable-order Markov model over
32 symbols. A URL that no rule decides is scored by the difference of its log-likelihoods per symbol and judged
against a threshold calibrated on labelled URLs that did not train the models.

DataFrame functions only. Counting combines before its shuffle and its result is bounded by the alphabet
(32 ** order contexts of 32 weights, 10 MB at order 3), so the model is broadcast whatever the size of the input.

Defined results: a NULL URL, or one without ``://``, has empty host and path and fits no rule; the empty text is
scored like any other. If the rules label no URL of one class there is nothing to compare and undecided URLs are
allowed; if they label some, but none in the calibration fold or none outside it, all labelled URLs train the models
and the threshold is 0, where both are equally likely. Repeated rows are judged alike; other columns of the input are kept unless they bear the name of a result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.session import cut_lineage

LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Codes 1 to 30 are the places in this text, 0 is any other character, 31 the edge of a URL. Digits count as one symbol.
ALPHABET = LETTERS + "0./-"
EDGE, BITS = 31, 5
FOLDS = 5
BIN = 0.01


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, all its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, LETTERS.upper(), LETTERS)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else NULL."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def grams(url: Column, order: int) -> Column:
    """Codes of all runs of ``order + 1`` symbols of the whole URL, edges included, as integers of 5 bits a symbol."""
    plain = F.translate(F.lower(F.coalesce(url, F.lit(""))), "123456789", "000000000")
    characters = F.filter(F.split(plain, ""), lambda c: c != "")
    codes = F.transform(characters, lambda c: F.call_function("instr", F.lit(ALPHABET), c))
    edge = F.lit(EDGE)
    padded = F.concat(F.array(*[edge] * order), codes, F.array(edge))

    # Bound as a lambda's variable, the padded symbols are computed once for a URL.
    def runs(symbols: Column) -> Column:
        def at(i):
            run = [F.element_at(symbols, (i - k).cast("int")) for k in range(order, -1, -1)]
            return reduce(lambda left, right: left * F.lit(1 << BITS) + right, run)

        return F.transform(F.sequence(F.lit(order + 1), F.size(symbols)), at)

    return F.element_at(F.transform(F.array(padded), runs), 1)


def _probabilities(counts: DataFrame, label: str, order: int) -> DataFrame:
    """Dense (gram, p): Witten-Bell smoothing over the contexts of 0 to ``order`` symbols; an unseen context leaves
    the shorter one's probability as it is."""
    spark = counts.sparkSession
    below = spark.range(1 << BITS).select(F.col("id").alias("gram"), F.lit(1.0 / (1 << BITS)).alias("p"))
    for k in range(order + 1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << BITS * (k + 1)) - 1))
        seen = counts.where(F.col(label) > 0).groupBy(suffix.alias("gram")).agg(F.sum(label).alias("n"))
        context = seen.groupBy(F.shiftright("gram", BITS).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        shorter = below.withColumnRenamed("gram", "shorter")
        every = spark.range(1 << BITS * (k + 1)).select(
            F.col("id").alias("gram"),
            F.shiftright("id", BITS).alias("context"),
            F.col("id").bitwiseAND(F.lit((1 << BITS * max(k, 1)) - 1)).alias("shorter"),
        )
        joined = every.join(shorter, "shorter").join(context, "context", "left").join(seen, "gram", "left")
        n, total, kinds = (F.coalesce(c, F.lit(0)) for c in ("n", "total", "kinds"))
        below = joined.select("gram", F.when(total > 0, (n + kinds * F.col("p")) / (total + kinds)).otherwise(F.col("p")).alias("p"))
    return below


def fit(labelled: DataFrame, url: str, label: str, order: int = 3) -> DataFrame:
    """(context, weights): the log-ratio of each symbol after a context, from all rows whose ``label`` is allow or block."""
    found = labelled.select(F.col(label).alias("_label"), F.explode(grams(F.col(url), order)).alias("gram"))
    counts = found.groupBy(F.col("gram").cast("bigint").alias("gram")).agg(
        F.count_if(F.col("_label") == "allow").alias("allow"), F.count_if(F.col("_label") == "block").alias("block")
    )
    counts = cut_lineage(counts)
    allow = _probabilities(counts, "allow", order)
    block = _probabilities(counts, "block", order).withColumnRenamed("p", "q")
    ratios = allow.join(block, "gram").select("gram", (F.log("p") - F.log("q")).alias("w"))
    ordered = F.sort_array(F.collect_list(F.struct("gram", "w")))
    return ratios.groupBy(F.shiftright("gram", BITS).alias("context")).agg(F.transform(ordered, lambda g: g.w).alias("weights"))


def score(urls: DataFrame, url: str, model: DataFrame, order: int = 3) -> DataFrame:
    """(url, score) of the distinct URLs, NULL as the empty one: log-likelihood ratio per symbol, rounded to 9 digits.

    Above 0 a URL resembles accepted ones. One shuffle, on the URL, serves the distinct step and the sums.
    """
    distinct = urls.select(F.coalesce(F.col(url), F.lit("")).alias("url")).distinct()
    found = distinct.select("url", F.explode(grams(F.col("url"), order)).alias("gram"))
    known = found.withColumn("context", F.shiftright("gram", BITS).cast("bigint")).join(F.broadcast(model), "context")
    weight = F.element_at("weights", (F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1)) + 1).cast("int"))
    return known.groupBy("url").agg(F.round(F.avg(weight), 9).alias("score"))


def calibrate(scored: DataFrame, score: str, label: str) -> float:
    """Threshold with the best mean of the hit rates of both classes, which must have rows. Works on counts by bins of
    ``BIN``, whose number is bounded by the range of the log-ratio."""
    bins = scored.groupBy(F.floor(F.col(score) / BIN).alias("bin")).agg(
        F.count_if(F.col(label) == "allow").alias("a"), F.count_if(F.col(label) == "block").alias("b")
    )
    rows = sorted((r["bin"], r["a"], r["b"]) for r in bins.collect())
    allowed, blocked = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best, at, kept, stopped = -1.0, 0.0, allowed, 0
    for edge, a, b in rows:  # accept what lies at or above the lower edge of the bin
        rate = kept / allowed + stopped / blocked
        if rate > best:
            best, at = rate, edge * BIN
        kept, stopped = kept - a, stopped + b
    return at


def filter_urls(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, order: int = 3) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the model's score (NULL where a rule decides or no model could be trained)."""
    address = F.col(url)
    judged = pages.drop("_rule", "_key", "_url").withColumns({"host": host_of(address), "path": path_of(address)})
    judged = judged.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    labelled = judged.where(F.col("_rule").isNotNull()).select(address.alias("url"), F.col("_rule.verdict").alias("label"))
    labelled = labelled.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)))
    classes = labelled.groupBy("label").agg(F.count_if(F.col("fold") == 0).alias("held"), F.count_if(F.col("fold") != 0).alias("rest")).collect()
    if len(classes) < 2:
        model, threshold = None, None
    elif any(not r["held"] or not r["rest"] for r in classes):
        model, threshold = cut_lineage(fit(labelled, "url", "label", order)), 0.0
    else:
        model = cut_lineage(fit(labelled.where("fold <> 0"), "url", "label", order))
        held_out = labelled.where("fold = 0")
        threshold = calibrate(held_out.join(score(held_out, "url", model, order), "url"), "score", "label")
    decided = judged.withColumns({"rule": F.col("_rule.rule"), "verdict": F.col("_rule.verdict")}).drop("_rule", "score")
    if model is None:
        return decided.withColumns({"score": F.lit(None).cast("double"), "verdict": F.coalesce("verdict", F.lit("allow"))})
    open_cases = decided.where(F.col("verdict").isNull()).withColumn("_key", F.coalesce(address, F.lit("")))
    points = score(open_cases, "_key", model, order).withColumnRenamed("url", "_url")
    judged_by_model = open_cases.join(points, F.col("_key") == F.col("_url")).drop("_key", "_url")
    judged_by_model = judged_by_model.withColumn("verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    by_rule = decided.where(F.col("verdict").isNotNull()).withColumn("score", F.lit(None).cast("double"))
    return by_rule.unionByName(judged_by_model)
