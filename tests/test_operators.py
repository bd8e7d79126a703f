"""Operators against plain Python on small tables: ties, nulls, repeats, empty tables and hot groups."""

import datetime
import random
from collections import Counter

from pyspark.sql import functions as F

from harvestry.functions import titles, urls
from harvestry.operators.captures import duplicate_groups, merged_index, project_address
from harvestry.operators.choose import first_rows, last_row_wins, most_frequent, spaced_days, top_counts, unique_or_nothing
from harvestry.operators.lookups import lookup_with_fallback, overlay, pending
from harvestry.operators.orders import entry_order, episode_order
from harvestry.operators.repairs import fill_blanks, take_longer
from harvestry.operators.resolve import resolve_articles
from harvestry.operators.search import inverted_index, matches
from harvestry.operators.skew import attach_groups, look_up


def test_first_rows_ties_nulls_and_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else None if i % 5 == 0 else f"k{i % 40}", rng.randint(0, 5), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, rank_in_group int, seq int")
    best = {}
    for k, v, s in sorted(rows, key=lambda r: (-r[1], r[2])):
        best.setdefault(k, []).append(s)
    out = first_rows(df, ["k"], [F.desc("rank_in_group"), F.asc("seq")], 2)
    assert out.columns == df.columns
    assert sorted(r.seq for r in out.collect()) == sorted(s for v in best.values() for s in v[:2])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert first_rows(df.filter("false"), ["k"], [F.asc("seq")]).count() == 0


def test_log_lookups(spark):
    log = spark.createDataFrame([("a", 1, "ok"), ("a", 2, "bad"), ("b", 3, "ok")], "k string, seq int, status string")
    assert {(r.k, r.status) for r in last_row_wins(log, ["k"], "seq").collect()} == {("a", "bad"), ("b", "ok")}
    targets = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert {r.k for r in pending(targets, log, "k", F.col("status") == "ok").collect()} == {"c"}
    pairs = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("b", "2"), ("c", ""), (None, "3")], "k string, v string")
    assert [(r.key, r.value) for r in unique_or_nothing(pairs, F.col("k"), F.col("v")).collect()] == [("a", "1")]


def test_fallback_takes_the_first_key_that_matches_even_with_a_null_value(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "q", "x"), (3, "q", "q"), (4, "n", "x"), (5, None, "a")], "seq int, k1 string, k2 string")
    right = spark.createDataFrame([("a", "A"), ("x", "X"), ("n", None)], "k string, v string")
    out = lookup_with_fallback(left, right, [F.col("k1"), F.col("k2")], "k", "v")
    assert {(r.seq, r.v, r.found_by) for r in out.collect()} == {(1, "A", 1), (2, "X", 2), (3, None, None), (4, None, 1), (5, "A", 2)}
    row = spark.range(1).select(overlay(F.lit("a"), F.lit("")).alias("x"), overlay(F.lit("a"), F.lit("b")).alias("y"), overlay(F.lit("a"), F.lit(None)).alias("z")).first()
    assert (row.x, row.y, row.z) == ("a", "b", "a")


def test_counts_with_ties(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "", 3), ("a", None, 4), ("b", None, 5)], "k string, v string, seq int")
    assert [(r.k, r.v, r.n) for r in most_frequent(df, "k", "v", "seq").collect()] == [("a", "x", 1)]
    assert [(r.v, r.n) for r in top_counts(df, "v", "seq", 2).collect()] == [("(unknown)", 3), ("x", 1)]


def test_spaced_days_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(k, datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randint(0, 300))) for k in ("a", "b", None) for _ in range(80)] + [("a", None)]
    expected = set()
    for k in {r[0] for r in rows}:
        last = None
        for d in sorted({d for q, d in rows if q == k and d}):
            if last is None or (d - last).days >= 20:
                expected.add((k, d))
                last = d
    out = spaced_days(spark.createDataFrame(rows, "k string, at date"), "k", F.col("at"), 20)
    assert {(r.k, r.day) for r in out.collect()} == expected


def test_merged_index_keeps_first_at_ties_and_ignores_blank_times(spark):
    rows = [("k", "", "20200101", "404", "", "", "", "cdx", 1), ("k", "u1", "20200301", "200", "m1", "d1", "1", "cdx", 2), ("k", "u2", "20200301", "500", "m2", "d2", "2", "cdx", 3), ("k", "u3", "", "999", "m", "d", "3", "sitemap", 4), ("", "u", "1", "", "", "", "", "cdx", 5), (None, "u", "1", "", "", "", "", "cdx", 6), ("q", None, None, None, None, None, None, "sitemap", 7)]
    df = spark.createDataFrame(rows, "urlkey string, url string, ts string, status string, mimetype string, digest string, length string, origin string, seq bigint")
    out = {r.urlkey: r for r in merged_index(df).collect()}
    assert set(out) == {"k", "q"}
    k = out["k"]
    assert (k.url, k.first_seen_ts, k.last_seen_ts, k.latest_status, k.latest_digest, k.observations, k.source) == ("u1", "20200101", "20200301", "200", "d1", 3, "cdx+sitemap")
    assert (out["q"].url, out["q"].last_seen_ts, out["q"].latest_status, out["q"].observations) == (None, None, None, 0)


def test_project_address_folds_in_order(spark):
    rng = random.Random(8)
    rows, kept = [], {}

    def better(new, old):
        a, b = (new.count("/"), len(new)), (old.count("/"), len(old))
        return a < b or (new.endswith("/") and not old.endswith("/"))

    for k in range(60):
        urls = list(dict.fromkeys("http://p/" + "/".join(rng.choice(("a", "bb", "ccc")) for _ in range(rng.randint(1, 4))) + rng.choice(("", "/")) for _ in range(rng.randint(1, 12))))
        for i, u in enumerate(urls):
            rows.append((f"k{k}", u, f"c{i}", "h", "/p", "project", "200", "text/html", "cdx", len(rows)))
            kept[f"k{k}"] = u if i == 0 or better(u, kept[f"k{k}"]) else kept[f"k{k}"]
    df = spark.createDataFrame(rows + rows[:1], "rollup_key string, url string, canonical_key string, host string, path string, kind string, latest_status string, latest_mimetype string, source string, seq int")
    assert {r.rollup_key: r.url for r in project_address(df, "seq").collect()} == kept
    assert project_address(df.filter("false"), "seq").count() == 0


def test_look_up_of_hot_and_null_keys(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", 500), ("none", 501), (None, 502)]
    df = spark.createDataFrame(rows, "k string, n int")
    groups = spark.createDataFrame([("hot", 1), ("cold", 2), ("other", 3)], "k string, v int")
    out = look_up(df, groups, ["k"]).collect()
    assert sorted((r.n, r.k, r.v) for r in out if r.k) == sorted((n, k, {"hot": 1, "cold": 2}.get(k)) for k, n in rows if k)
    assert [(r.n, r.v) for r in out if r.k is None] == [(502, None)]


def test_duplicate_groups_sample_in_order(spark):
    rows = [("d", f"u{i}", f"h{i % 2}", i) for i in range(50)] + [("-", "a", "h", 100), ("-", "b", "h", 101), ("", "c", "h", 102), (None, "d", "h", 103), ("one", "e", "h", 104)]
    out = duplicate_groups(spark.createDataFrame(rows, "digest string, url string, host string, seq int"), "digest", "seq", 3).collect()
    assert [(r.digest, r.url_count, r.host_count, r.sample_urls) for r in out] == [("d", 50, 2, "u0 u1 u2")]


def test_attach_groups_equals_a_join(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 3000)}", i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, seq int")
    groups = df.groupBy("k").agg(F.count("*").alias("n"), F.min("seq").alias("m"))
    out = attach_groups(df, groups, ["k"], "n", len(rows))
    n = Counter(k for k, _ in rows)
    assert {(r.k, r.seq, r.n) for r in out.collect()} == {(k, s, n[k]) for k, s in rows} and out.count() == len(rows)


def test_resolved_articles(spark):
    rows = [
        (1, "article:wp/2010/01/a", "article", "u", "Ann", "T", "2010-01-02"), (2, "article:a-longer-slug-here", "article", "u", "Bob", "T", "2010-01-02T10"),
        (3, "article:b", "article", "u", "", "S", "2011-01-01"), (4, "article:bb", "article", "u", "Cy", "s ", "2011-01-01"),
        (5, "article:c", "article", "u", "Di", "R", "2012-01-01"), (6, "article:cc", "article", "u", "Ed", "R", "2012-01-01"),
        (7, "podcast:x", "podcast", "u", "", "T", "2010-01-02"), (8, "article:n", "article", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "seq int, id string, kind string, url string, byline string, title string, date string")
    out = resolve_articles(df, titles.title_key(F.col("title")), F.col("id").startswith("article:wp/"))
    assert sorted((r.seq, r.byline_seq) for r in out.collect()) == [(2, 1), (4, 4), (5, 5), (6, 6), (7, 7), (8, 8)]


def test_search_matches_all_terms_by_prefix_or_slip(spark):
    df = spark.createDataFrame([(1, "Polling Errors Matter", "Ann"), (2, "Poling errors", "Matt R"), (3, "Errors only", None), (4, None, None)], "seq int, title string, byline string")
    index = inverted_index(df, "seq", ["title", "byline"])
    assert {r.seq for r in matches(index, "seq", ["polling", "error"]).collect()} == {1, 2}
    assert {r.seq for r in matches(index, "seq", ["error", "matt"]).collect()} == {1, 2}
    assert matches(index.filter("false"), "seq", ["a"]).count() == 0


def test_canonical_keys(spark):
    cases = {
        "https://www.A.example:443/x/?utm_source=q&b=2&a=1#f": "a.example/x?a=1&b=2", "http://a.example": "a.example/", "http://a.example/%zz/?q=a+b&c": "a.example/%zz?c&q=a b", "": "", "  ": "", "http://u:p@a.example/x//": "a.example/x",
        "http://a.example/?REF=1&fbclid=2": "a.example/", "//a.example/y": "a.example/y", "http://a_b.example/x|y": "a_b.example/x|y",
    }
    df = spark.createDataFrame([(u,) for u in cases] + [(None,)], "u string")
    got = {r.u: r.k for r in df.select("u", urls.canonical_key(F.col("u")).alias("k")).collect()}
    assert got == cases | {None: None}


def test_authors_and_titles(spark):
    cases = {"By NATE O'NEIL and Ann Lee": ["Nate O'Neil", "Ann Lee"], "x@y.z (Jo Doe)": ["Jo Doe"], "Ann, and Bo / Cy | ann": ["Ann", "Bo", "Cy"], "Published Feb. 16": [], "Staff": [], "": []}
    df = spark.createDataFrame([(b,) for b in cases], "b string")
    assert {r.b: list(r.a) for r in df.select("b", titles.authors_of(F.col("b")).alias("a")).collect()} == cases
    names = spark.createDataFrame([(["A"],), (["A", "B"],), (["A", "B", "C"],), ([],)], "n array<string>")
    assert [r.j for r in names.select(titles.joined_names(F.col("n")).alias("j")).collect()] == ["A", "A and B", "A, B, and C", ""]
    raw = {"  A  Title | Tallyboard ": "A Title", "Tallyboard": "", "| Tallyboard": "", "Tallyboard: News": "News", None: ""}
    df = spark.createDataFrame([(t,) for t in raw], "t string")
    assert {r.t: r.c for r in df.select("t", titles.clean_title(F.col("t")).alias("c")).collect()} == raw
    assert spark.createDataFrame([("Zoë Ø. ß漢",)], "t string").select(titles.slugify(F.col("t")).alias("a"), titles.slugify(F.col("t"), True).alias("b")).first() == ("zoe", "zoe")


def test_ordered_lists_are_whole(spark, small):
    from harvestry.plans import registry

    queries = registry.queries()
    articles = queries["o4_all_articles"](spark, small).collect()
    assert len(articles) == spark.read.parquet(f"{small}/site_records.parquet").count()
    assert articles[:1000] == queries["o4_article_order"](spark, small).collect()
    groups = queries["o3_all_groups"](spark, small).collect()
    assert len(groups) == spark.read.parquet(f"{small}/url_records.parquet").groupBy("canonical_key").count().filter("count > 1").count()
    assert groups[:100] == queries["o3_largest_groups"](spark, small).collect()


def test_orders_of_lists(spark):
    rows = [(1, "2016-01-02", "beta"), (2, "", "Álpha"), (3, None, "alpha"), (4, "2015-01-01", "Beta"), (5, "2016-01-02", None)]
    df = spark.createDataFrame(rows, "seq int, date string, title string")
    seqs = lambda order: [r.seq for r in df.orderBy(*order).collect()]
    assert seqs(entry_order("date", True)) == [1, 5, 4, 2, 3] and seqs(entry_order("date", False)) == [4, 1, 5, 2, 3]
    assert seqs(entry_order("title", False)) == [5, 2, 3, 1, 4] and seqs(entry_order("title", True)) == [1, 4, 2, 3, 5]
    assert seqs(episode_order("date", False)) == [4, 5, 1, 3, 2] and seqs(episode_order("date", True)) == [3, 2, 5, 1, 4]


def test_repairs_mend_and_never_spoil(spark):
    rows = [(None, "x"), ("", "x"), (" ", None), ("a", "x"), (None, None)]
    df = spark.createDataFrame(rows, "v string, n string")
    assert [r[0] for r in df.select(fill_blanks(F.col("v"), F.col("n"))).collect()] == ["x", "x", " ", "a", None]
    dates = spark.createDataFrame([("2016", "2016-05"), ("2016-05", "2016"), (None, "2016"), ("2016", None), ("2016", "2017")], "v string, n string")
    assert [r[0] for r in dates.select(take_longer(F.col("v"), F.col("n"))).collect()] == ["2016-05", "2016-05", "2016", "2016", "2016"]


def test_slugs_fold_by_an_explicit_table(spark):
    cases = {"Émilie Zoë O’Hara": ("emilie-zoe-ohara", "emilie-zoe-o-hara"), "A & B / C--D": ("a-b-c-d", "a-b-c-d"), "Nicolás Peña": ("nicolas-pena", "nicolas-pena"), "ÀÉÎÕÜ ç": ("aeiou-c", "aeiou-c"), "漢字 x": ("x", "x"), "": ("", ""), None: ("", "")}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: (r.a, r.b) for r in df.select("t", titles.slugify(F.col("t")).alias("a"), titles.slugify(F.col("t"), True).alias("b")).collect()} == cases


def test_addresses_are_classified_by_the_first_rule(spark):
    cases = {
        "https://www.tallyboard.example/2014/05/Some--Thing.html": ("article", "article:wp/2014/05/Some-Thing"), "http://projects.tallyboard.example/a%20b/c/": ("project", "project:a-b/c"), "https://tallyboard.example/tag/x--y/": ("tag", "tag:/tag/x--y/"),
        "https://tallyboard.example": ("homepage", "site:/"), "https://other.example//x": ("other", "other:/x"), None: ("other", None),
    }
    df = spark.createDataFrame([(u, 1) for u in cases], "u string, page int")
    out = urls.classified(df, F.col("u"), "found")
    assert out.columns == ["u", "page", "found"]
    assert {r.u: tuple(r.found) for r in out.collect()} == cases
