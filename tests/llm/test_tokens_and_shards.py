"""BPE codec and token files against the tokenizers library, sharding against its law."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodgeframe.llm import bpe, sharding, token_files

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
POOL = [*"aaabcdeéßÿÀİΣσςſKÅ  \n\t\x0b\x1c\x85'’sdll.,!?;:0123漢😀̸̧ <>|=", "<|endoftext|>", "'ll", "the ", "Don't", "≠", "\r\n", "aaaaaaa", "½"]


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(POOL, k=rng.randint(0, 60))) for _ in range(n)] + ["", " ", "a" * 5000, "ab" * 3000, "<|endoftext|>" * 3]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_bpe_equals_library(spark):
    rows = [(i, t) for i, t in enumerate(texts(1500))] + [(None, None), (0, "same"), (0, "same")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("old"))
    coded = bpe.decode(bpe.encode(docs, BYTES), BYTES).collect()
    tokenizer = library(BYTES)
    assert len(coded) == len(rows)
    for r in coded:
        want = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == tokenizer.decode(want, skip_special_tokens=False) == (r["text"] or "")
    assert bpe.encode(docs.limit(0), BYTES).count() == 0


def test_decoding_ids_that_are_no_text(spark):
    one = bpe.load(BYTES)
    ids = [i for i, b in enumerate(one.bytes_of) if b == b"\xff"][:1] + [0]
    frame = spark.createDataFrame([(ids,), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(frame, BYTES).collect()] == ["�!", "", ""]


@pytest.mark.parametrize("top", [1, 255, 256, 65_535, 65_536, 1 << 25])
def test_codes_give_every_id_directly(top):
    ids = np.random.default_rng(top).integers(0, top + 1, 3000)
    codes = token_files.Dac(token_files.Dac.pack(ids))
    assert (codes.all() == ids).all()
    assert [codes.get(i) for i in range(0, 3000, 7)] == ids[::7].tolist()
    with pytest.raises(IndexError):
        codes.get(3000)
    assert token_files.Dac(token_files.Dac.pack(ids[:0])).all().tolist() == []


def test_token_files_equal_library(spark, tmp_path):
    rows = [(i * 3 % 997, t) for i, t in enumerate(texts(900))] + [(None, "null id"), (None, None), (5, "tie"), (5, "tie")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit("old")).repartition(5)
    token_files.write_tokens(docs, f"{tmp_path}/t", WORDS, block_tokens=500)
    found = sorted(token_files.read_documents(spark, f"{tmp_path}/t").collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k)) and len(keys) == len(rows)
    tokenizer = library(WORDS)
    want = sorted((k is not None, k, ids) for k, t in rows for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids + [1]])
    at, got = 0, []
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
        got.append((r["doc_id"] is not None, r["doc_id"], r["n_tokens"], r["ids_crc32"]))
    assert sorted(got) == sorted((a, k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for a, k, ids in want)
    unique = [r for r in found if keys.count(r["doc_id"]) == 1]
    by_key = {k: ids for _, k, ids in want}
    asked = [(r["start"] + j, by_key[r["doc_id"]][j]) for r in unique[::9] for j in (0, r["n_tokens"] // 2)]
    answer = token_files.tokens_at(spark, f"{tmp_path}/t", spark.createDataFrame([(p,) for p, _ in asked] + [(at,), (-1,)], "position bigint"))
    assert {tuple(r) for r in answer.collect()} == set(asked)


def test_empty_token_file(spark, tmp_path):
    token_files.write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), f"{tmp_path}/t", WORDS)
    assert token_files.read_documents(spark, f"{tmp_path}/t").count() == 0


@pytest.mark.parametrize("n", [0, 5, 1000])
def test_shards_are_equal_and_gapless(spark, tmp_path, n):
    rows = [(i if i % 5 else None, None if i % 7 == 0 else "copy" if i % 3 == 0 else f"é{i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("slot", F.lit("old")).withColumn("keep", F.lit(1))
    found = sharding.shuffle_into_shards(docs, f"{tmp_path}/s", 16, bucket_bytes=500).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in found) == sorted((str(a), str(b)) for a, b in rows)
    slots = {k: sorted(r["slot"] for r in found if r["shard"] == k) for k in range(16)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for r in found:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"], r["keep"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None, 1)


def test_order_is_random(spark, tmp_path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    found = sorted(sharding.shuffle_into_shards(docs, f"{tmp_path}/s", 4).collect(), key=lambda r: (r["shard"], r["slot"]))
    place = np.array([r["doc_id"] for r in found])
    assert abs(np.corrcoef(place, np.arange(2000))[0, 1]) < 0.1
    assert abs(np.corrcoef(place[:-1], place[1:])[0, 1]) < 0.1
