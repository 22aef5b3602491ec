"""URL filter, secrets, toxicity, licenses and decontamination against plain Python."""

import hashlib
import math
import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import decontaminate, license_scan, secret_scan, toxicity, url_filter

SMALL = "/root/testdata/sf0.001"
LONG = "x" * 300_000


# URL filter


def plain_parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")


def plain_rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), r.text)) if fits else None


def plain_grams(url, order=3):
    place = {c: i + 1 for i, c in enumerate(url_filter.ALPHABET)}
    codes = [31] * order + [place.get("0" if c in "123456789" else c, 0) for c in (url or "").lower()] + [31]
    return [sum(codes[i - k] << (5 * k) for k in range(order + 1)) for i in range(order, len(codes))]


def plain_model(urls, order=3):
    counts = defaultdict(int)
    for url in urls:
        for g in plain_grams(url):
            counts[g] += 1
    levels = []
    for k in range(order + 1):
        seen, total, kinds = defaultdict(int), defaultdict(int), defaultdict(int)
        for g, n in counts.items():
            seen[g & ((1 << 5 * (k + 1)) - 1)] += n
        for g, n in seen.items():
            total[g >> 5] += n
            kinds[g >> 5] += 1
        levels.append((seen, total, kinds))

    def probability(gram):
        p = 1 / 32
        for k, (seen, total, kinds) in enumerate(levels):
            g = gram & ((1 << 5 * (k + 1)) - 1)
            if total[g >> 5]:
                p = (seen[g] + kinds[g >> 5] * p) / (total[g >> 5] + kinds[g >> 5])
        return p

    return probability


URLS = [None, "", "no scheme", "http://A.Example.NET/en/x", "https://example.net/de/", "http://example.com/de/1?q=/fr/", "x://org/fr/é", "http://net", "HTTP://x.ORG/fr/#a"]


def test_url_parts_rules_and_scores(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url")
    extra = spark.createDataFrame([(-i, u) for i, u in enumerate(URLS, 1)] + [(-1, "http://dup.example.com/a")] * 2, "page_id bigint, url string")
    rows = url_filter.filter_urls(pages.unionByName(extra).withColumn("score", F.lit("old")).withColumn("_key", F.lit(1))).collect()
    assert len(rows) == pages.count() + len(URLS) + 2
    labelled = defaultdict(list)
    fold = {r["url"]: r["f"] for r in pages.unionByName(extra).select("url", F.pmod(F.xxhash64("url"), F.lit(url_filter.FOLDS)).alias("f")).collect()}
    for r in rows:
        host, path = plain_parts(r["url"])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        if rule:
            assert r["verdict"] == rule.verdict and r["score"] is None
            if fold[r["url"]]:
                labelled[rule.verdict].append(r["url"])
    allow, block = plain_model(labelled["allow"]), plain_model(labelled["block"])
    undecided = [r for r in rows if r["rule"] is None]
    for r in undecided:
        grams = plain_grams(r["url"])
        want = sum(math.log(allow(g)) - math.log(block(g)) for g in grams) / len(grams)
        assert r["score"] == pytest.approx(want, abs=1e-6)
    worst_kept = min(r["score"] for r in undecided if r["verdict"] == "allow")
    assert all(r["score"] < worst_kept for r in undecided if r["verdict"] == "block")


def test_urls_without_labels_are_allowed(spark):
    rows = url_filter.filter_urls(spark.createDataFrame([(1, "http://a.b/c"), (2, None)], "page_id bigint, url string")).collect()
    assert [(r["verdict"], r["score"]) for r in rows] == [("allow", None)] * 2
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


@pytest.mark.parametrize("held", [True, False])
def test_few_labelled_urls_train_the_models_whole(spark, held):
    """All blocked URLs lie inside the calibration fold, or outside it: undecided URLs are judged all the same."""
    blocked = [f"http://bad{i}.net/{w}" for i in range(60) for w in ("win", "prize")]
    frame = spark.createDataFrame([(u,) for u in blocked], "url string").withColumn("f", F.pmod(F.xxhash64("url"), F.lit(url_filter.FOLDS)))
    blocked = [r["url"] for r in frame.where("f = 0" if held else "f <> 0").collect()][:5]
    urls = blocked + [f"http://good{i}.org/fr/{w}" for i in range(20) for w in ("news", "page")] + ["http://bad7.com/prize", "http://good7.com/fr/news"]
    rows = url_filter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")).collect()
    got = {r["url"]: (r["rule"], r["verdict"], r["score"] is None) for r in rows}
    assert got["http://bad7.com/prize"] == (None, "block", False) and got["http://good7.com/fr/news"] == (None, "allow", False)


# Secrets


def plain_secrets(text):
    found = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern = "[0-9a-f]+" if rule.kind == "hex" else rule.pattern
        least = (0, 24) if rule.kind == "hex" else rule.least
        found += [(m.start(), rank, m.end(), rule.kind) for m in re.finditer(pattern, text or "") if len(m[least[0]]) >= least[1]]
    return [(k, a, b) for a, _, b, k in sorted(found)]


SECRETS = [
    None,
    "",
    "token=abcdef1 AKIA" + "B" * 30 + " secret=token:abcdef1 ghp_" + "a" * 36,
    "é😀 API_KEY : 'zzzzzzz' " + "ab" * 20 + " Passwd=short PASSWORD=\"longer1\"",
    "y" * 4090 + "password=123456" + "z" * 9000 + "Password" + " " * 5000 + "= sixsix",
    LONG + " secret: abcdefgh " + "0" * 30,
    "-----BEGIN RSA PRIVATE KEY----- eyJabcdefghijk.eyJabcdefghijk.abcdefghijkl xoxb-1234567890-ab",
    "pass sec tok",
]


def test_secrets_equal_plain_regexes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-i, t) for i, t in enumerate(SECRETS)], "doc_id bigint, text string"))
    rows = secret_scan.find_secrets(docs.withColumn("secrets", F.lit("old"))).withColumn("masked", secret_scan.redact(F.col("text"), F.col("secrets"))).collect()
    assert sum(len(r["secrets"]) for r in rows) > 8
    for r in rows:
        want = plain_secrets(r["text"])
        assert [tuple(s) for s in r["secrets"]] == want
        masked, at = "", 0
        for _, a, b in want:
            if a >= at:
                masked += r["text"][at:a] + "<secret>"
            at = max(at, b)
        assert r["masked"] == (masked + r["text"][at:] if want else r["text"])


def test_index_prunes_and_lists_blocks(spark):
    docs = spark.createDataFrame([(1, "my token is"), (2, "nothing"), (3, "a" * 5000 + "secret")], "doc_id bigint, text string")
    asked = docs.select("doc_id", secret_scan.candidates(F.col("text"), secret_scan.RULES).alias("a")).collect()
    first = {r["doc_id"]: r["a"][0] for r in asked}
    assert first == {1: True, 2: False, 3: True} and all(r["a"][2] for r in asked)
    posted = {(r["trigram"], r["doc_id"]): r["blocks"] for r in secret_scan.postings(docs).collect()}
    assert posted[("tok", 1)] == [0] and posted[("cre", 3)] == [1] and ("tok", 2) not in posted


def test_queries_are_derived_from_the_regex():
    clauses = {r.kind: r.clauses for r in secret_scan.RULES}
    assert set(clauses["assign"][0]) == {"password", "passwd", "secret", "token", "apikey", "api_key"} and len(clauses["assign"]) == 1
    assert clauses["access"] == (("akia",),) and clauses["hex"] == ()
    assert clauses["private_key"] == (("-----begin ",), ("private key-----",))
    assert clauses["github"] == (("gho_", "ghp_", "ghr_", "ghs_", "ghu_"),)
    assert clauses["jwt"] == ((".eyj",), ("eyj",))
    assert secret_scan.Rule("k", "key-[0-9]{4}").clauses == (("key-",),)
    assert secret_scan.Rule("k", "(?:abc|x+)def").clauses == (("def",),)
    assert secret_scan.Rule("k", "(?:abc+|[^q]xyz)?").clauses == ()
    assert secret_scan.Rule("k", "(?:abcd+|[^q]xyz|uvw)").clauses == (("abc", "uvw", "xyz"),)


@pytest.mark.parametrize("pattern", [r.pattern for r in secret_scan.RULES] + ["key-[0-9]{4}", "(ab|cd){2,3}e?f", "a(?:bc|d+)e[xy]z", "(?i:Ab)c*(de){2}", "x{3}y", "(abc)?def|gh+i"])
def test_every_match_holds_a_text_of_each_clause(pattern):
    draw = random.Random(pattern)
    clauses = secret_scan.Rule("k", pattern).clauses
    alphabet = sorted(set("".join(t for c in clauses for t in c) + "abcdefghixyzAB019 -_.:=\"'"))
    texts = [t for c in clauses for t in c] + ["ab", "cd", "gh", "i", "key-", "dd", "de", "exz", "abce", "eyJabcdefghij", ".eyJabcdefghij.", ".eyJabcdefghij.abcdefghij", "AKIA", "a" * 40, "ghp_", "xoxb-", "PRIVATE KEY-----", "-----BEGIN ", "Secret='", "0123"]
    found = 0
    for _ in range(20_000):
        text = "".join(draw.choice(texts) if draw.random() < 0.5 else draw.choice(alphabet) for _ in range(draw.randrange(1, 8)))
        for m in re.finditer(pattern, text):
            found += 1
            assert all(any(t in m[0].lower() for t in clause) for clause in clauses), (m[0], clauses)
    assert found


def test_many_matches_take_no_quadratic_time(spark):
    text = "token=abcdef1 é " * 80_000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    started = time.perf_counter()
    found = secret_scan.find_secrets(docs).withColumn("masked", secret_scan.redact(F.col("text"), F.col("secrets"))).collect()[0]
    assert time.perf_counter() - started < 20
    assert [(s.start, s.end) for s in found["secrets"]] == [(16 * i, 16 * i + 13) for i in range(80_000)]
    assert found["masked"] == "<secret> é " * 80_000


# Toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, y in enumerate(b, 1):
            after.append(min(row[j] + 1, after[-1] + 1, row[j - 1] + (x != y)))
        row = after
    return row[-1]


def test_automata_equal_edit_distance():
    rng = random.Random(1)
    terms = [toxicity.Term(w, False, 1.0) for w in toxicity.GENERAL] + [toxicity.Term("vequ", True, 2.0), toxicity.Term("abominabl", True, 2.0)]
    words = {"", "vequx", "equx", "abominbly", "abominxbly", "idiot" * 20}
    for term in toxicity.GENERAL * 20:
        letters = list(term)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(letters) + 1)
            letters[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "e", "t"])
        words.add("".join(letters))
    got = toxicity.Trie(terms).match(sorted(words))
    for word in words:
        reach = []
        for t in terms:
            starts = [word[:n] for n in range(len(word) + 1)] if t.stem else [word]
            errors = min(edits(s, t.text) for s in starts)
            if errors <= t.budget and len(word) <= toxicity.LONGEST:
                reach.append(errors)
        assert (got[word][1] if word in got else None) == (min(reach) if reach else None), word


def test_families_of_forms_are_narrowed_as_defined():
    """Held against the definition, form against form."""
    draw = random.Random(5)
    for _ in range(200):
        words = {"".join(draw.choice("ab") for _ in range(draw.randrange(3, 13))) for _ in range(12)}
        forms = {f for w in words for f in (w, *(w[:n] + "*" for n in toxicity.STEM_LETTERS if len(w) >= n))}
        found = {f: (draw.randrange(3, 60), draw.uniform(2.5, 8)) for f in sorted(forms) if draw.random() < 0.6}
        kept = {}
        for form in found:
            longer = [f for f in found if f != form and form.endswith("*") and f.startswith(form[:-1])]
            if not any(found[f][0] >= 0.95 * found[form][0] for f in longer):
                kept[form] = found[form]
        stems = {f[:-1]: odds for f, (_, odds) in kept.items() if f.endswith("*")}
        want = set()
        for form, (_, odds) in kept.items():
            text = form.rstrip("*")
            if not any(text.startswith(s) and form != s + "*" and odds < of_stem + 2 for s, of_stem in stems.items()):
                want.add((text, form.endswith("*"), odds))
        assert {(t.text, t.stem, t.weight) for t in toxicity.narrowed(found)} == want


def test_rare_terms_pass_on_evidence_alone(spark):
    """Three toxic texts of 400 hold the term, under a hundredth, and no clean one."""
    clean = "the house stands by the river and the people walk along the road to the market every day"
    rows = [(f"{clean} {i}" + " brakzul" * 5 if i < 3 else f"{clean} {i} grimvock grimvock", 1) for i in range(400)] + [(f"{clean} {i}", 0) for i in range(1_200)]
    terms = {t.text for t in toxicity.learn_terms(spark.createDataFrame(rows, "text string, toxic int"))}
    assert any("brakzul".startswith(t) for t in terms) and any("grimvock".startswith(t) for t in terms)


def test_quotation_weighs_less_than_abuse():
    scorer = toxicity.Scorer([toxicity.Term("idiot", False, 4.0)])
    abuse, quoted, none = scorer.features(["you idiot!", 'he said "idiot" is a word', ""])
    exact = toxicity.FEATURES.index("exact")
    assert abuse[exact] > quoted[exact] > 0 and not none.any()


def test_toxicity_finds_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", F.lit(1).alias("score"))
    extra = spark.createDataFrame([(None, "fine"), (-1, None), (-2, ""), (-3, "worthless moron, stupid scum " * 20_000), (-3, "a")], "doc_id bigint, text string")
    docs = docs.unionByName(extra.withColumn("score", F.lit(1)))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").unionByName(
        spark.createDataFrame([(None, 1, 1), (-2, 1, None)], "doc_id bigint, quality int, toxic int")
    )
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).collect()
    assert len(rows) == 1005 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    by_id = {(r["doc_id"], r["text"]): r["predicted"] for r in rows}
    assert by_id[(-1, None)] == by_id[(-2, "")] == by_id[(None, "fine")] == 0 and by_id[(-3, "worthless moron, stupid scum " * 20_000)] == 1
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(r["predicted"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and toxic.get(r["doc_id"]) is not None]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)


def test_toxicity_without_labels_uses_general_terms(spark):
    docs = spark.createDataFrame([(1, "you worthless pathetic moron"), (2, "good day")], "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()} == {1: 1, 2: 0}


# Licenses


def test_licenses_equal_plain_containment(spark):
    rng = random.Random(4)
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()
    texts = [None, "", "all rights", LONG, "ALL   Rights\nreserved. all rights reserved"]
    for name, template in license_scan.TEMPLATES * 6:
        words = template.split()
        for _ in range(rng.randint(0, max(0, len(words) // 20))):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(rng.choices(filler, k=rng.randint(0, 50))) + " É " + " ".join(words) + " " + " ".join(rng.choices(filler, k=30)))
    docs = spark.createDataFrame(list(enumerate(texts)) + [(0, "All rights reserved")], "doc_id bigint, text string").withColumn("license", F.lit("old"))
    rows = license_scan.find_licenses(docs).collect()
    found = defaultdict(set)
    for r in rows:
        text = texts[r["doc_id"]] or "All rights reserved"
        assert r["containment"] >= license_scan.CONTAINMENT and 0 <= r["start"] < r["end"] <= len(text)
        found[r["doc_id"]].add(r["template"])
    assert found[0] == found[4] and len(found[4]) == 1
    for i, text in enumerate(texts[5:], 5):
        words = license_scan.WORD.findall(text.lower())
        for n, (_, template) in enumerate(license_scan.TEMPLATES):
            wanted = license_scan.shingles(license_scan.WORD.findall(template.lower()))
            if len(license_scan.shingles(words) & wanted) >= license_scan.CONTAINMENT * len(wanted):
                assert n in found[i], (n, text)


# Decontamination


def test_edited_items_are_found_as_by_brute_force(spark):
    rng = random.Random(2)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(20)
    known = {r["item_id"]: r["text"] for r in items.collect()}
    extra = [(900, None), (901, ""), (902, "short item"), (None, "x"), (0, known[0])]
    items = items.unionByName(spark.createDataFrame(extra, "item_id bigint, text string"))
    docs = [(-1, None, 0), (-2, "", 0), (-3, LONG, 0), (-4, "a SHORT\titem here", 0), (-5, "ashort items", 0)]
    for i in range(60):
        item = rng.choice(sorted(known))
        letters = list(decontaminate.folded(known[item]))
        for _ in range(rng.randint(0, int(0.13 * len(letters)))):
            at = rng.randrange(len(letters))
            letters[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "z"])
        docs.append((i, "İntro " * rng.randint(0, 9) + "".join(letters).replace(" ", " \n") + " outro" * rng.randint(0, 5), item))
    frame = spark.createDataFrame([d[:2] for d in docs], "doc_id bigint, text string")
    rows = decontaminate.find_matches(frame, items).collect()
    got = {(r["doc_id"], r["item_id"]): r for r in rows}
    assert (-4, 902) in got and not any(r["doc_id"] in (-1, -2, -3, -5) for r in rows)
    for key, text, item in docs[5:]:
        want = decontaminate.folded(known[item])
        masks = decontaminate.occurrence_masks(want)
        distance, _ = decontaminate.nearest(masks, len(want), decontaminate.folded(text))
        assert ((key, item) in got) == (distance <= int(0.1 * len(want)))
        if (key, item) in got:
            r = got[(key, item)]
            assert r["distance"] == distance == edits(decontaminate.folded(text[r["start"] : r["end"]]), want)
    kept = decontaminate.with_matches(frame.withColumn("matches", F.lit(1)), items).where(F.size("matches") == 0)
    assert kept.count() == len(docs) - len({r["doc_id"] for r in rows})
    assert decontaminate.with_matches(frame, items.limit(0)).where(F.size("matches") == 0).count() == len(docs)


def test_short_items_end_at_word_boundaries():
    matcher = decontaminate.Matcher([("blue whale", [1]), ("(a) of 42%", [2])], 0.1)
    hits = lambda text: [(i, start) for i, start, _, _ in matcher.matches(text)]
    for text in ('"blue whale"', "(blue whale)", "a blue whale.", "the blue whale, or", "blue whale?", "is:blue whale;", "blue whale"):
        assert hits(text) == [(0, text.index("blue"))]
    for text in ("blue whales", "2blue whale", "skyblue whale.", "blue whale_x", "blue whale\u0301"):
        assert hits(text) == []
    assert hits("x(a) of 42%y") == [(1, 1)]


def test_edited_copies_beside_exact_ones_are_found():
    rng = random.Random(12)
    item = "".join(rng.choices("abcdefghijklmnop", k=200))
    matcher = decontaminate.Matcher([(item, [1])], 0.1)
    edited = list(item)
    for at in (30, 80, 130, 170):
        edited[at] = "z"
    edited = "".join(edited)
    for between in ("", " ", " and then "):
        second = 200 + len(between)
        assert sorted(matcher.matches(edited + between + item)) == [(0, 0, 200, 4), (0, second, second + 200, 0)]
        assert sorted(matcher.matches(item + between + edited)) == [(0, 0, 200, 0), (0, second, second + 200, 4)]


def test_items_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK_CHARACTERS", 300)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(6)
    docs = items.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("so "), "text").alias("text"))
    assert {(r[0], r[1], r[4]) for r in decontaminate.find_matches(docs, items).collect()} == {(r["doc_id"], r["doc_id"], 0) for r in docs.collect()}
    assert decontaminate.with_matches(docs, items).where(F.size("matches") == 1).count() == 6


def test_digests_are_plain(spark):
    spans = spark.range(1).select(F.sha2(secret_scan.spans_text(F.array().cast("array<struct<kind:string,start:int,end:int>>")), 256).alias("h"))
    assert spans.first()["h"] == hashlib.sha256(b"").hexdigest()
