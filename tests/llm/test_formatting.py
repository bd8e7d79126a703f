import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from harvestry.functions.text import spelling_key
from harvestry.llm import formatting
from harvestry.llm.formatting import collapse_spellings, hidden_copies, may_repeat, repeat_filter


def brute_key(text):
    head, _, tail = text.lower().partition("?")
    clean = lambda s: re.sub(r"[\W_]+", "", s)
    parts = sorted(p for p in map(clean, re.split("[&?]", tail)) if p)
    return clean(head) + ("?" + "&".join(parts) if parts else "")


SPELLINGS = ["http://A.example/x-y/?b=2&a=1", " HTTP://a.example/x_y?a=1&b=2,", "http://a.example/xy", "http://a.example/xz", "http://a.example/x?y=1", "http://a.example/x?y=2", "(http://a.example//x y)", "", "--", "é/È?", "É/è"]


def test_key_agrees_with_brute_force(spark):
    df = spark.createDataFrame([(s,) for s in SPELLINGS] + [(None,)], "t string")
    got = {r.t: r.k for r in df.select("t", spelling_key(F.col("t")).alias("k")).collect()}
    assert got == {s: brute_key(s) for s in SPELLINGS} | {None: None}


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "s", 9) for i, t in enumerate(texts)], "seq bigint, url string, spelling string, key_hash int").repartition(5)


def test_groups_agree_with_brute_force(spark):
    texts = [f"https://a.example/{'hot' if i % 3 == 0 else i % 700}{'/' * (i % 2)}{'?a=1&b=2' if i % 5 else '?b=2&a=1'}" for i in range(4000)] + [None, "", None]
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        if t and brute_key(t):
            groups[brute_key(t)].append(i)
    expected = {(g[0], i) for g in groups.values() for i in g[1:]}
    key = F.when(spelling_key(F.col("url")) != "", spelling_key(F.col("url")))
    out = hidden_copies(frame(spark, texts), key, "seq")
    assert {(r.first_seq, r.seq) for r in out.collect()} == expected
    whole = collapse_spellings(frame(spark, texts), key, "seq")
    assert whole.columns == ["seq", "url", "spelling", "key_hash", "copies"]
    rows = whole.collect()
    assert sum(r.copies for r in rows) == len(texts)
    assert sorted(r.seq for r in rows) == sorted([g[0] for g in groups.values()] + [4000, 4001, 4002])


def test_filter_never_misses_a_repeat(spark):
    values = np.random.default_rng(1).integers(-(2**62), 2**62, 20_000)
    hashes = [int(v) for v in values] + [int(v) for v in values[:500]]
    df = spark.createDataFrame([(h,) for h in hashes], "h bigint").repartition(7)
    marked = df.select("h", may_repeat(repeat_filter(df, "h", len(hashes)), F.col("h")).alias("m"))
    passed = {r.h for r in marked.filter("m").collect()}
    assert {int(v) for v in values[:500]} <= passed and len(passed) < 1500


def test_full_filter_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(formatting, "plane_power", lambda rows: 6)
    df = frame(spark, [f"u{i % 400}" for i in range(500)])
    assert hidden_copies(df, spelling_key(F.col("url")), "seq").count() == 100


def test_small_segments_stay_exact_and_pass_little_but_repeats(spark, monkeypatch):
    monkeypatch.setattr(formatting, "LEAST_POWER", 13)
    monkeypatch.setattr(formatting, "MOST_POWER", 13)
    texts = ["hot"] * 1000 + [f"u{i}" for i in range(3000)] + [f"u{i}" for i in range(200)]
    df, key = frame(spark, texts), spelling_key(F.col("url"))
    rows, segments = formatting._hashed(df, key, len(texts))
    possible, single = formatting._split(rows, segments, len(texts))
    assert segments == 9 and possible.count() + single.count() == len(texts) and possible.count() < 1400 + 300
    assert hidden_copies(df, key, "seq").count() == 999 + 200
    assert collapse_spellings(df, key, "seq").count() == 3001


def test_empty_and_long(spark):
    key = spelling_key(F.col("url"))
    assert hidden_copies(frame(spark, ["a"]).filter("false"), key, "seq").count() == 0
    assert collapse_spellings(frame(spark, ["a"]).filter("false"), key, "seq").count() == 0
    assert hidden_copies(frame(spark, ["x" * 100_000, "X" * 100_000 + "!"]), key, "seq").count() == 1
