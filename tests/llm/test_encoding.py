import random

import pytest
from pyspark.sql import functions as F

from jobweave.llm import encoding
from jobweave.llm.encoding import bpe, decode, encode, load_ranks, token_counts, vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
TEXTS = [
    None, "", " ", "\n\n  \t", "Hello world", "It's  we'll\n\n\nDON'T ", "Kỹ sư phần mềm – Hà Nội  ", "Kỹ sư", "東京で働くエンジニアを募集しています。年間休日は21日以上", "🚀🔥👩‍💻 ok", "a" * 700, "ab" * 300,
    "x　y\xa0 z w\x85v\x1c u", "1234567890 12,5% ---- ====", "<|endoftext|>", "﻿BOM​", "é́", "สวัสดีครับ ทำงาน", "Привет мир", "مرحبا", "  leading and trailing   ", "tab\tsep\r\nline", "<p>x</p>&nbsp;",
]


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(vocabulary_path(name="byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_ids_equal_the_public_library(spark, reference):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("aáb 漢字ộ.'\n0🚀") for _ in range(rng.randint(1, 90))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, ids string").repartition(5)
    got = {r.doc_id: list(r.ids) for r in encode(df, "doc_id", "text").collect()}
    assert got == {i: reference(t) for i, t in enumerate(texts)}
    counted = {r.doc_id: r.n_tokens for r in token_counts(df, "doc_id", "text").collect()}
    assert counted == {i: len(v) for i, v in got.items()}
    back = {r.doc_id: r.text for r in decode(encode(df, "doc_id", "text"), "doc_id", "ids").collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}


def test_fold_and_heap_agree(spark):
    rng = random.Random(2)
    ranks = load_ranks(vocabulary_path())
    words = list({"".join(rng.choice("etaoinshrdluộ漢") for _ in range(rng.randint(1, 14))) for _ in range(80)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: list(r.ids) for r in df.select("word", encoding.fold_word(F.col("word"), vocabulary_path()).alias("ids")).collect()}
    assert got == {w: bpe(w.encode(), ranks) for w in words}


def test_shuffled_dictionary_gives_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"the the the word{i % 7} x") for i in range(40)], "doc_id int, text string")
    want = sorted((r.doc_id, list(r.ids)) for r in encode(df, "doc_id", "text").collect())
    real = encoding.lookup_join
    monkeypatch.setattr(encoding, "lookup_join", lambda *a: real(*a, broadcast_bytes=1))
    assert sorted((r.doc_id, list(r.ids)) for r in encode(df, "doc_id", "text").collect()) == want


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "d")], "doc_id int, text string")
    assert sorted(((r.doc_id, len(r.ids)) for r in encode(df, "doc_id", "text").collect()), key=str) == [(1, 1), (1, 2), (None, 1)]
    assert encode(df.limit(0), "doc_id", "text").collect() == []


@pytest.mark.parametrize("broadcast_bytes", [24_000_000, 1])
def test_rare_and_long_words_go_back_to_their_places(spark, reference, monkeypatch, broadcast_bytes):
    rng = random.Random(3)
    texts = ["", None, "the the the"] + [" ".join(rng.choice(["the", "of", "Xyzzyology", "漢字" * 60, "ab" * 80, "=" * 300, "naïveté", "q" + str(rng.randrange(10**9))]) for _ in range(rng.randint(1, 25))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(5, texts[5])], "doc_id int, text string")
    real = encoding.lookup_join
    monkeypatch.setattr(encoding, "HOT_WORDS", 2)
    monkeypatch.setattr(encoding, "lookup_join", lambda *a: real(*a, broadcast_bytes=broadcast_bytes))
    got = {r.doc_id: list(r.ids) for r in encode(df, "doc_id", "text").collect()}
    assert got == {i: reference(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in token_counts(df, "doc_id", "text").collect()} == {i: len(v) for i, v in got.items()}
