"""Queries that write tables as the formats harvests land in and parse them again, and streaming queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, table
from ..sources import formats
from ..streaming.jobs import keep_index, windowed_counts

#: Rows of a table that make one landed document.
ROWS = 200


def _escaped(c: str) -> Column:
    text = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _documents(df: DataFrame, piece: Column, glue: str) -> DataFrame:
    """(page, body): `ROWS` rows by seq to a document, their pieces in order."""
    rows = df.select(F.floor(F.col("seq") / ROWS).alias("page"), "seq", piece.alias("piece"))
    return rows.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "piece"))), lambda x: x["piece"]), glue).alias("body"))


def s4_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.to_json(F.array(*[F.coalesce(c, F.lit("")) for c in ("urlkey", "last_seen_ts", "url", "latest_mimetype", "latest_status", "latest_digest", "latest_length")]))
    pages = _documents(table(spark, sf_dir, "url_records"), cells, ",")
    header = F.to_json(F.array(*map(F.lit, formats.CAPTURE)))
    text = pages.select("page", F.concat(F.lit("["), header, F.lit(","), "body", F.lit(',["resume"]]')).alias("text"))
    return formats.capture_rows(text, "text").select("page", "at", *formats.CAPTURE)


def s9_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.concat(F.lit("<url><loc>"), _escaped("url"), F.lit("</loc></url>"))
    pages = _documents(table(spark, sf_dir, "curated"), entries, "\n")
    xml = pages.select("page", F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), "body", F.lit("</urlset>")).alias("xml"))
    return formats.sitemap_urls(xml, "xml")


def s10_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.concat(F.lit("<item><title>"), _escaped("title"), F.lit("</title><link>"), _escaped("url"), F.lit("</link><dc:creator>"), _escaped("byline"), F.lit("</dc:creator><pubDate>"), _escaped("published_at"), F.lit("</pubDate></item>"))
    pages = _documents(table(spark, sf_dir, "feed_entries"), item, "")
    xml = pages.select("page", F.concat(F.lit('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>'), "body", F.lit("</channel></rss>")).alias("xml"))
    return formats.feed_rows(xml, "xml")


def s11_time_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "enriched")
    line = F.concat(F.lit("<"), "wayback_url", F.lit('>; rel="'), F.when(F.col("seq") % 5 == 0, "first memento").otherwise("memento"), F.lit('"; datetime="'), F.coalesce("snapshot_timestamp", F.lit("")), F.lit('",'))
    maps = _documents(rows.filter("wayback_url is not null"), line, "\n").select("page", F.concat(F.lit('<https://tallyboard.example/>; rel="original",\n'), "body").alias("text"))
    return formats.memento_times(maps, "text").groupBy("ts").agg(F.count("*").alias("n"))


def s24_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    piece = F.concat(F.lit('"shard-'), F.col("seq").cast("string"), F.lit('":'), F.to_json(F.struct((F.col("latest_status") == "200").alias("done"), F.col("urlkey").alias("resume_key"), F.col("snapshot_observations").alias("rows"))))
    states = _documents(table(spark, sf_dir, "url_records"), piece, ",").select("page", F.concat(F.lit('{"shards":{'), "body", F.lit("}}")).alias("text"))
    return formats.state_records(states, "text").groupBy("done").agg(F.count("*").alias("shards"), F.sum("rows").alias("rows"))


def n1_page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written in four ways by turns, as the harvested ones are, and read again."""
    rows = table(spark, sf_dir, "site_records").select("seq", _escaped("title").alias("t"), _escaped("byline").alias("b"), _escaped("date").alias("d"))
    way = F.col("seq") % 4
    head = (
        F.when(way == 0, F.concat(F.lit('<meta property="og:title" content="'), "t", F.lit('"><meta name="author" content="'), "b", F.lit('"><meta property="article:published_time" content="'), "d", F.lit('">')))
        .when(way == 1, F.concat(F.lit("<title>"), "t", F.lit('</title><script type="application/ld+json">{broken</script><time datetime="'), "d", F.lit('">then</time><a rel="author" href="/x">'), "b", F.lit("</a>")))
        .when(way == 2, F.concat(F.lit('<meta name="twitter:title" content="'), "t", F.lit('"><meta name="date" content="'), "d", F.lit('"><meta name="parsely-author" content="'), "b", F.lit('">')))
        .otherwise(F.concat(F.lit("<h1>"), "t", F.lit('</h1><meta property="article:author" content="'), "b", F.lit('"><time datetime="'), "d", F.lit('">')))
    )
    pages = rows.select("seq", F.concat(F.lit("<html><body>"), head, F.lit("<p>text</p></body></html>")).alias("html"))
    return formats.extracted(pages, "html").select("seq", "title", "byline", "published_at", "via")


def n7_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "podcast_metadata").withColumn("thumbnail", F.concat(F.lit("https://img.example/"), "show_slug", F.lit("/"), "seq", F.lit(".png"))).filter("thumbnail is not null")
    html = F.concat(F.lit('<figure><img src="'), "thumbnail", F.lit('" srcset="'), "thumbnail", F.lit("?w=100 100w, "), "thumbnail", F.lit('?w=300 300w"></figure>'))
    found = formats.extracted(rows.select("seq", html.alias("html")), "html")
    return found.select("seq", F.posexplode("images").alias("at", "image"))


def n11_audio_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "podcast_metadata").filter("player_url is not null")
    return rows.select("seq", F.explode(formats.audio_urls(F.col("player_url"))).alias("audio"))


def n12_event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", F.explode(formats.first_json_map(F.concat(F.lit("answer: "), "props"))).alias("name", "value"))


def e1_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = windowed_counts(table(spark, sf_dir, "events"))
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


def e2_streamed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of all events, streamed as several files in several batches that merge."""
    landed = new_folder(spark)
    table(spark, sf_dir, "events").withColumn("landed", F.col("event_type")).write.partitionBy("landed").parquet(landed)
    events = spark.readStream.schema(spark.read.parquet(landed).schema).option("maxFilesPerTrigger", 2).parquet(landed)
    source = events.select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("key"), F.date_format("ts", "yyyyMMdd").alias("ts"), "event_id")
    return keep_index(spark, source, new_folder(spark), "key", "ts", "event_id")


_TEXT = "regexp_replace({}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g')"
_TRIM = "trim({}, ' ' || chr(9) || chr(10) || chr(13))"
_WIDE = r"trim(regexp_replace(regexp_replace(coalesce({}, ''), '[\x{{00a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{0085}}]', ' ', 'g'), '\s+', ' ', 'g'))"
_ENDS = r"regexp_replace(coalesce({}, ''), '^[\s\x{{0085}}\x{{00a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+|[\s\x{{0085}}\x{{00a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+$', '', 'g')"
SQL = {
    "s4_captures": f"""select seq // {ROWS} as page, (row_number() over (partition by seq // {ROWS} order by seq))::int as at, coalesce(urlkey, '') as urlkey, coalesce(last_seen_ts, '') as timestamp, coalesce(url, '') as original, coalesce(latest_mimetype, '') as mimetype,
        coalesce(latest_status, '') as statuscode, coalesce(latest_digest, '') as digest, coalesce(latest_length, '') as length from url_records""",
    "s9_sitemaps": f"select seq // {ROWS} as page, trim(url) as loc from curated where url <> ''",
    "s10_feeds": f"""select seq // {ROWS} as page, (row_number() over (partition by seq // {ROWS} order by seq) - 1)::int as at, {', '.join(f"{_ENDS.format(c)} as {c}" for c in ('url', 'title', 'byline', 'published_at'))} from feed_entries""",
    "s11_time_maps": "select * from (select regexp_extract(wayback_url, '/([0-9]{14})(?:[a-z]{2}_)?/', 1) as ts, count(*) as n from enriched where wayback_url is not null group by 1) where ts <> ''",
    "s24_states": "select latest_status = '200' as done, count(*) as shards, sum(snapshot_observations)::bigint as rows from url_records group by 1",
    "n1_page_facts": f"""select seq, {_WIDE.format('title')} as title, {_WIDE.format('byline')} as byline, {_WIDE.format('date')} as published_at,
        concat_ws('+', case when {_WIDE.format('title')} = '' then null when seq % 4 = 0 then 'og' when seq % 4 = 1 then 'title' when seq % 4 = 2 then 'twitter' else 'h1' end, case when {_WIDE.format('date')} = '' then null when seq % 4 in (0, 2) then 'meta' else 'time' end) as via from site_records""",
    "n7_images": "select seq, unnest([0, 1, 2])::int as at, unnest([t, t || '?w=300', t || '?w=100']) as image from (select seq, 'https://img.example/' || show_slug || '/' || seq || '.png' as t from podcast_metadata) where t is not null",
    "n11_audio_urls": r"""select seq, unnest(list_distinct(regexp_extract_all(player_url, 'https?://[^\s"''<>\\]+?\.mp3'))) as audio from podcast_metadata where player_url is not null""",
    "n12_event_properties": "select event_id, unnest(json_keys(props)) as name, unnest(list_transform(json_keys(props), lambda k: json_extract_string(props, '$.' || k))) as value from events",
    "e1_event_windows": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
    "e2_streamed_index": """with e as (select user_id || '/' || event_type as key, strftime(ts, '%Y%m%d') as ts, event_id from events), r as (select *, row_number() over (partition by key order by ts desc, event_id) as nth from e)
        select key, min(ts) as first_ts, max(ts) as last_ts, max(case when nth = 1 then event_id end) as latest_event_id, count(*) as n from r group by 1""",
}
QUERIES = {n: f for n, f in globals().items() if n[:2] in ("s4", "s9", "s1", "s2", "n1", "n7", "e1", "e2") and callable(f)}
