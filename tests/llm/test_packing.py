import random

from harvestry.llm.packing import BestFit, pack_texts
from harvestry.llm.tokens import count_tokens


def test_best_fit_against_brute_force():
    rng = random.Random(3)
    packer, bins = BestFit(100, 0, open_bins=5), {}
    for _ in range(3000):
        size = rng.randint(0, 100)
        still = {b: used for b, used in bins.items() if b in set(packer.left())}
        fits = [used for used in still.values() if used + size <= 100]
        at = packer.put(size)
        assert (at in still) == bool(fits)
        if fits:
            assert still[at] == max(fits)
        bins[at] = bins.get(at, 0) + size
        assert bins[at] <= 100 and len(packer.left()) <= 5


def place(spark, texts, capacities=(16, 64)):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, bin string").repartition(3)
    kinds = spark.createDataFrame([(n, c, "byte_bpe_50k") for n, c in enumerate(capacities, 1)], "container_id bigint, capacity_tokens bigint, tokenizer string")
    return pack_texts(df, "doc_id", "text", kinds)


def test_every_text_is_placed_whole_or_split_only_when_too_large(spark):
    rng = random.Random(1)
    texts = [None, "", " "] + ["word " * rng.randint(1, 40) for _ in range(300)] + ["word " * 500] + ["same text"] * 5
    sizes = count_tokens(texts, "byte_bpe_50k")
    rows = place(spark, texts).collect()
    for kind, capacity in ((1, 16), (2, 64)):
        own = [r for r in rows if r.container_id == kind]
        used = {}
        for r in own:
            used[r.bin] = used.get(r.bin, 0) + r.tokens
        assert max(used.values()) <= capacity
        for doc, size in enumerate(sizes):
            pieces = sorted((r.part, r.start_token, r.tokens) for r in own if r.doc_id == doc)
            assert sum(p[2] for p in pieces) == size and [p[0] for p in pieces] == list(range(len(pieces)))
            assert [p[1] for p in pieces] == [sum(q[2] for q in pieces[:k]) for k in range(len(pieces))]
            assert len(pieces) == 1 or size > capacity
        assert len(used) <= 1.25 * -(-sum(sizes) // capacity) + 2


def test_empty_tables(spark):
    assert place(spark, ["a"]).filter("false").count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    kinds = spark.createDataFrame([(1, 16, "byte_bpe_50k")], "container_id bigint, capacity_tokens bigint, tokenizer string")
    assert pack_texts(empty, "doc_id", "text", kinds).count() == 0
