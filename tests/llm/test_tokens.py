import random

import pytest
import tiktoken

from harvestry.llm.tokens import BytePairs, PATTERN, byte_pairs, count_tokens, encode_texts, read_ranks, vocabulary_path

PATH = vocabulary_path("byte_bpe_50k")
TEXTS = [None, "", " ", "\n\n  \t", "Hello world", "<|endoftext|> is text", "naïve café — “quotes”", "漢字かな交じり文 ελληνικά русский", "👩‍👩‍👧‍👦 zero​width", "a" * 30_000, " " * 5_000, "x = {1: [2, 3]}\r\n\tif x:\n", "1234567890" * 50, "don't we'll I'M", "\x00\x01é", "ﷺ" * 20]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_texts_of_all_kinds(spark, reference):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "y")], "doc_id bigint, text string, ids string")
    rows = encode_texts(df, "doc_id", "text").collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = TEXTS[r.doc_id]
        assert r.ids == (reference.encode_ordinary(text) if text else [])
    assert encode_texts(df.filter("false"), "doc_id", "text").count() == 0


def test_random_words_need_exact_merging(reference):
    rng = random.Random(5)
    words = ["".join(rng.choice("aeioutnrshldETHzq") for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    pairs = byte_pairs(PATH)
    got = pairs.encode_words(words)
    held = pairs.verified([pairs.propose(w.encode()) for w in words])
    assert 0 < held.sum() < len(words)
    assert all(got[w] == reference.encode_ordinary(w) for w in words)


def test_json_and_tiktoken_vocabularies_agree():
    assert {b: i for b, i in read_ranks(PATH.replace(".tiktoken", ".json")).items() if i < 50256} == read_ranks(PATH)


def test_counts(reference):
    assert count_tokens(TEXTS, "byte_bpe_50k") == [len(reference.encode_ordinary(t)) if t else 0 for t in TEXTS]
    assert count_tokens([None, ""], "piece_bpe_32k") == [0, 0]


def test_small_caches_change_nothing(monkeypatch, reference):
    monkeypatch.setattr("harvestry.llm.tokens.KEPT_WORDS", 3)
    pairs = BytePairs(read_ranks(PATH))
    for text in ("one two three four five one two", "one two six seven"):
        ids, offsets = pairs.encode_batch([text])
        assert ids.tolist() == reference.encode_ordinary(text) and offsets.tolist() == [0, len(ids)]
