from pyspark.sql import functions as F

from harvestry.sources import formats
from harvestry.sources.tables import append_log, read_json_array, read_optional, read_text_csv, write_csv, write_jsonl
from harvestry.streaming.jobs import keep_index, windowed_counts


def one(spark, text):
    return spark.createDataFrame([(1, text)], "page int, text string")


def test_capture_pages(spark):
    text = '[["urlkey","timestamp","original"],["k","2020","u","text/html","200","D","9"],["k2","2021"],["resume here"]]'
    rows = formats.capture_rows(one(spark, text), "text").collect()
    assert [(r.urlkey, r.timestamp, r.length) for r in rows] == [("k", "2020", "9"), ("k2", "2021", "")]
    keys = spark.createDataFrame([(text,), ('[["k","1"]]\n\nnext,key)/ 2020',), ('[["k","1"]]',)], "t string").select(formats.resume_key(F.col("t")).alias("k"))
    assert [r.k for r in keys.collect()] == ["resume here", "next,key)/ 2020", ""]
    assert formats.capture_rows(one(spark, "not json"), "text").count() == 0 == formats.capture_rows(one(spark, None), "text").count()


def test_sitemaps_and_time_maps(spark):
    xml = '<sitemapindex xmlns="http://x"><sitemap><loc> http://a/1 </loc></sitemap><sitemap><loc>http://a/2</loc></sitemap></sitemapindex>'
    assert [r.loc for r in formats.sitemap_urls(one(spark, xml), "text").collect()] == ["http://a/1", "http://a/2"]
    lines = '<http://x>; rel="original",\n<http://w/web/20200101000000/http://x>; rel="first memento"; datetime="x",\n<http://w/web/2020/x>; rel="memento"\n<http://w/web/20210101000000id_/http://x>; rel="memento"'
    assert [r.ts for r in formats.memento_times(one(spark, lines), "text").collect()] == ["20200101000000", "20210101000000"]


def test_feeds(spark):
    rss = '<rss><channel><item><title>T</title><link>http://a</link><creator xmlns="dc">B</creator><pubDate>D</pubDate></item><item><title/><enclosure url="http://m.mp3"/></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>T2</title><link href="http://b"/><author><name>N</name></author><updated>U</updated></entry></feed>'
    rows = formats.feed_rows(spark.createDataFrame([(1, rss), (2, atom), (3, "<broken"), (4, None)], "page int, text string"), "text").collect()
    assert sorted((r.page, r.url, r.title, r.byline, r.published_at) for r in rows) == [(1, "http://a", "T", "B", "D"), (1, "http://m.mp3", "", "", ""), (2, "http://b", "T2", "N", "U")]


def test_pages_fall_back_from_best_to_worst():
    page = """<head><title>Plain</title><meta property="og:title" content="A &amp; B"><script type="application/ld+json">{"@graph": [{"headline": "LD", "author": [{"name": "X"}, "Y"], "datePublished": "2020-01-02"}]}</script>
        <script type="application/ld+json">{broken</script></head><body><h1>H</h1><time datetime="1999">x</time><img src="i.png" srcset="s.png 1x, l.png 300w"></body>"""
    facts = formats.page_facts(page)
    assert (facts["title"], facts["byline"], facts["published_at"], facts["via"], facts["images"]) == ("A & B", "X, Y", "2020-01-02", "og+jsonld", ["i.png", "l.png", "s.png"])
    assert formats.page_facts("<h1>Only</h1>")["title"] == "Only"
    assert formats.page_facts(None)["title"] == "" and formats.page_facts("<<<>>& <a")["via"] == ""


def test_texts_with_addresses_and_json(spark):
    row = spark.createDataFrame([("see https://a/x.mp3 and https%3A%2F%2Fb%2Fy.mp3 https://a/x.mp3 {\"k\": 1, \"v\": null} end",)], "t string").select(formats.audio_urls(F.col("t")).alias("a"), formats.first_json_map(F.col("t")).alias("m")).first()
    assert row.a == ["https://a/x.mp3", "https://b/y.mp3"] and row.m == {"k": "1", "v": None}


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", line\nbreak', ["x", "y"]), (2, None, [])], "seq int, t string, names array<string>")
    write_csv(df, str(tmp_path / "csv"), [F.asc("seq")])
    back = read_text_csv(spark, str(tmp_path / "csv"), ["seq", "t", "names"], "seq").orderBy("seq").collect()
    assert [(r.seq, r.t, r.names) for r in back] == [("1", 'a "quoted", line\nbreak', "x; y"), ("2", "", "")]
    write_jsonl(df.select("seq", "t"), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    (tmp_path / "array.json").write_text('[{"a": 1}, {"a": 2}]')
    assert read_json_array(spark, str(tmp_path / "array.json")).count() == 2
    assert read_optional(spark, str(tmp_path / "missing.csv"), ["a"]).count() == 0
    for _ in range(2):
        append_log(df.select("seq"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4


def test_streamed_index_equals_batch_and_counts_each_batch_once(spark, tmp_path):
    rows = [(f"k{i % 7}", f"2020{i % 12 + 1:02}", i) for i in range(300)]
    schema = "key string, ts string, seq bigint"
    for part in range(3):
        spark.createDataFrame(rows[part::3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    first = keep_index(spark, stream(), str(tmp_path / "out"), "key", "ts", "seq")
    spark.createDataFrame([("k0", "209901", 999)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    again = keep_index(spark, stream(), str(tmp_path / "out"), "key", "ts", "seq")
    expected = {}
    for k, t, s in [*rows, ("k0", "209901", 999)]:
        f, best, n = expected.get(k, (t, ("", 0), 0))
        expected[k] = (min(f, t), max(best, (t, -s)), n + 1)
    assert first.count() == 7
    assert {(r.key, r.first_ts, r.last_ts, r.latest_seq, r.n) for r in again.collect()} == {(k, f, b[0], -b[1], n) for k, (f, b, n) in expected.items()}


def test_windows_batch(spark):
    df = spark.createDataFrame([("2024-01-01 10:59:59", "a", 1.0), ("2024-01-01 11:00:00", "a", 2.0), ("2024-01-01 10:00:00", "a", None)], "ts string, event_type string, value double")
    out = windowed_counts(df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))).orderBy("window_start").collect()
    assert [(r.n, r.total) for r in out] == [(2, 1.0), (1, 2.0)]
