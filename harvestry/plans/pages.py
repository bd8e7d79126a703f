"""More queries of the site: targets of jobs, logs, listings in their orders, and small projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, urls
from ..functions.text import strip_blank
from ..operators.choose import first_rows, last_row_wins
from ..operators.skew import look_up
from ..session import table
from .index import path_sql
from .site import _CREDITS, _credits


def s8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shard per host and year that the captures span, both ends included."""
    spans = table(spark, sf_dir, "url_records").filter("first_seen_ts rlike '^[0-9]{14}$' and last_seen_ts rlike '^[0-9]{14}$'").groupBy("host").agg(F.min(F.left("first_seen_ts", F.lit(4))).cast("int").alias("a"), F.max(F.left("last_seen_ts", F.lit(4))).cast("int").alias("b"))
    return spans.select("host", F.explode(F.sequence("a", F.greatest("a", "b"))).alias("year"))


def s15_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.filter(F.transform(F.split("subject", ";"), lambda x: F.trim(x)), lambda x: x != "")
    return table(spark, sf_dir, "podcast_metadata").select(F.explode(parts).alias("subject")).groupBy("subject").agg(F.count("*").alias("n"))


def s23_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a player of each audio file, with the seq that orders them: one row for each, so that no list grows long."""
    rows = table(spark, sf_dir, "podcast_metadata").filter("player_url <> '' and mp3_url <> ''")
    return rows.groupBy("mp3_url", "player_url").agg(F.min("seq").alias("seq"))


def f3_fetchable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures that answered or may have, seen at some time, by whether they look like a sitemap."""
    rows = table(spark, sf_dir, "url_records").filter("(coalesce(latest_status, '') in ('', '-') or latest_status like '2__') and coalesce(last_seen_ts, '') <> ''")
    like = F.col("url").rlike(r"(?i)sitemap.*\.xml(\.gz)?$") | (F.contains("latest_mimetype", F.lit("xml")) & F.contains("url", F.lit("sitemap")))
    return rows.groupBy(F.coalesce(like, F.lit(False)).alias("sitemap"), "kind").agg(F.count("*").alias("n"))


def f5_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "url_records").filter(F.left("first_seen_ts", F.lit(4)).between("2012", "2016"))
    return rows.groupBy(F.left("first_seen_ts", F.lit(4)).alias("year"), "host").agg(F.count("*").alias("n"))


def f6_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    shim = (F.col("kind") == "project") & F.regexp_extract("id", r"([^/:]+)$", 1).rlike("^(?:embed|promo|lakes|coast)$")
    empty = (F.col("kind") == "liveblog") & (F.lower("title") == "headline")
    return table(spark, sf_dir, "site_records").filter(F.coalesce(shim, F.lit(False)) | F.coalesce(empty, F.lit(False))).select("seq", "id")


def f21_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to fetch: the latest good snapshot of each that isn't published yet."""
    rows = table(spark, sf_dir, "enriched").filter("http_status = '200' and url <> '' and wayback_url <> ''")
    done = table(spark, sf_dir, "site_records").select("url").filter("url is not null").distinct()
    return last_row_wins(rows.join(done, "url", "left_anti"), ["url"], "seq").select("url", "seq")


def f25_path_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "podcast_metadata").select("show_slug", F.regexp_extract(F.coalesce("mp3_url", F.lit("")), r"([^/]*)$", 1).alias("name"))
    return rows.groupBy("show_slug").agg((F.count("*") != F.count_distinct("name")).alias("path_sensitive"), F.count("*").alias("files"))


def f32_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "site_records").filter((F.col("year") == 2016) & F.col("date").startswith("2016-11")).select("seq", "date", "title")


def a16_last_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_row_wins(table(spark, sf_dir, "podcast_metadata").filter("identifier <> ''"), ["identifier"], "seq").select("identifier", "seq", "title")


def a22_fetch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "enriched")
    return rows.cube("kind", "http_status").agg(F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.grouping_id().cast("int").alias("level"))


def a26_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = F.when(F.col("kind") == "methodology", "article").otherwise(F.coalesce("kind", F.lit("(unknown)")))
    month = F.when(F.left("date", F.lit(4)) == F.col("year").cast("string"), F.when(F.length("date") >= 7, F.left("date", F.lit(7))))
    return table(spark, sf_dir, "site_records").groupBy(folded.alias("category"), month.alias("month")).agg(F.count("*").alias("n"))


def a28_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "enriched").agg(F.count_if(F.coalesce("error", F.lit("")) == "").alias("recovered"), F.count_if(F.coalesce("error", F.lit("")) != "").alias("errored"))


def a30_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "podcast_metadata").filter("mp3_url <> ''").select("seq", urls.audio_url(F.col("mp3_url")).alias("audio"))
    return rows.groupBy("audio").agg(F.min("seq").alias("seq"))


def a31_byline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _credits(spark, sf_dir).select("slug", "seq").distinct()


def a36_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.captures import EDITORIAL, qualifies

    rows = table(spark, sf_dir, "url_records")
    kept = F.col("kind").isin(*EDITORIAL) & qualifies()
    return rows.agg(F.count("*").alias("rows_in"), F.count_if(kept).alias("kept"), F.count_distinct(F.when(kept, F.col("rollup_key"))).alias("rows_out"))


def j10_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = last_row_wins(table(spark, sf_dir, "enriched").filter("http_status = '200' and wayback_url is not null").select("seq", "url", "wayback_url"), ["url"], "seq").drop("seq")
    return look_up(table(spark, sf_dir, "site_records").select("seq", "url"), log, ["url"]).select("seq", F.coalesce("wayback_url", F.lit("")).alias("archive_url"))


def j17_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = first_rows(table(spark, sf_dir, "curated"), ["canonical_key"], [F.asc("seq")]).select("canonical_key", "seq", "rollup_key")
    latest = last_row_wins(table(spark, sf_dir, "enriched"), ["rollup_key"], "seq").select("rollup_key", F.col("seq").alias("fetch_seq"), "http_status")
    return refs.join(latest, "rollup_key", "left").select("canonical_key", "seq", "fetch_seq", "http_status")


def j18_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The show that an identifier begins with; of several the longest. The shows are literals of a small table."""
    shows = ("tallyboard", "tallyboard-board-politics", "tallyboard-hot-streak", "tallyboard-model-talk")
    found = F.lit(None).cast("string")
    for show in shows:  # a longer one that fits replaces a shorter one
        found = F.when(F.col("identifier").startswith(show), show).otherwise(found)
    return table(spark, sf_dir, "podcast_metadata").select("seq", found.alias("show"))


def u18_enclosures(spark: SparkSession, sf_dir: str) -> DataFrame:
    episode = F.regexp_extract(F.col("mp3_url"), r"([A-Z]{3}\d{8,})", 1)
    made = F.when(episode != "", F.concat(F.lit("https://audio.castwell.example/"), episode, F.lit(".mp3"))).otherwise(F.substring_index("mp3_url", "?", 1))
    return table(spark, sf_dir, "podcast_metadata").select("seq", made.alias("enclosure"), episode.alias("episode"))


def u45_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without markup: tags and comments gone, common entities decoded, runs of blank lines made one."""
    text = F.regexp_replace(F.regexp_replace("text", r"(?s)<!--.*?-->", ""), r"<[/a-zA-Z][^<>]*>", "")
    for entity, mark in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(mark))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.regexp_replace(text, r"\n{3,}", "\n\n")).alias("text_md5"))


def u52_item_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an upload of each episode would say, blank fields dropped."""
    c = F.col
    fields = {"title": c("title"), "creator": c("creator"), "date": dates.site_date(c("date")), "mediatype": c("mediatype"), "year": dates.stated_year(c("date"))}
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(v, F.lit("")).alias("v")) for k, v in fields.items()])
    rows = table(spark, sf_dir, "podcast_metadata")
    return rows.select("seq", F.explode(F.filter(pairs, lambda p: p["v"] != "")).alias("p")).select("seq", F.col("p.k").alias("name"), F.col("p.v").alias("value"))


def u57_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.filter(F.transform(F.split("authors", ";"), lambda a: F.trim(a)), lambda a: a != "")
    return table(spark, sf_dir, "site_records").select("seq", F.when(F.size(listed) > 0, F.array_join(listed, ", ")).otherwise(F.col("byline")).alias("shown"), F.size(F.array_distinct(listed)).alias("distinct_authors"))


def n13_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", F.coalesce(F.get_json_object("props", "$.k"), F.get_json_object("props", "$.page"), F.lit("none")).alias("found"))


def n16_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.create_map(*[F.lit(x) for p in (("text/html", ".html"), ("application/xhtml+xml", ".html"), ("application/pdf", ".pdf"), ("image/png", ".png")) for x in p])
    suffix = F.nullif(F.regexp_extract(urls.path(strip_blank(F.col("url"))), r"(\.[a-z0-9]{2,5})$", 1), F.lit(""))
    ext = F.coalesce(F.try_element_at(known, F.col("latest_mimetype")), suffix, F.lit(".bin"))
    return table(spark, sf_dir, "url_records").groupBy(ext.alias("extension")).agg(F.count("*").alias("n"))


def o3_all_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group of two or more in order; `o3_largest_groups` is its first hundred rows, as its SQL has them."""
    rows = table(spark, sf_dir, "url_records").groupBy("canonical_key").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    return rows.filter("n > 1").orderBy(F.desc("n"), "first").select("canonical_key", "n")


def o3_largest_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "url_records").groupBy("canonical_key").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    return rows.filter("n > 1").orderBy(F.desc("n"), "first").limit(100).select("canonical_key", "n")


def o11_kind_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "site_records").groupBy("kind").agg(F.count("*").alias("n"))
    return rows.orderBy(F.col("kind") == "project", "kind")


def o12_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "site_records")
    return rows.orderBy(F.nullif("date", F.lit("")).desc_nulls_last(), F.desc("seq")).limit(250).select("seq", "date")


def o15_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten records at random, the same for the same seed wherever the rows lie."""
    rows = table(spark, sf_dir, "site_records").select("seq", "id", F.md5(F.concat(F.col("seq").cast("string"), F.lit("/7"))).alias("draw"))
    return rows.orderBy("draw", "seq").limit(10).select("seq", "id")


def x1_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("tab"), F.col("url")) for t in ("url_records", "curated", "enriched", "feed_entries", "site_records")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("tab").agg(F.count("*").alias("n"), F.count("url").alias("with_url"), F.count_distinct("url").alias("urls"))


_AUDIO = rf"regexp_replace(split_part(split_part(case when regexp_matches(mp3_url, '^[a-z]+://') then mp3_url else 'https://' || regexp_replace(mp3_url, '^//', '') end, '#', 1), '?', 1), '\.mp$', '.mp3')"
_DATE = "trim(coalesce(date, ''), ' ' || chr(9) || chr(10) || chr(13))"
_SITE = rf"case when regexp_full_match({_DATE}, '\d{{8}}|\d{{14}}') then concat_ws('-', {_DATE}[1:4], {_DATE}[5:6], {_DATE}[7:8]) when regexp_full_match({_DATE}, '\d{{6}}') then concat_ws('-', {_DATE}[1:4], {_DATE}[5:6]) else {_DATE} end"
_KEPT = """kind in ('article', 'liveblog', 'project', 'podcast', 'video', 'methodology') and (coalesce(latest_status, '') = '200' and coalesce(latest_mimetype, '') = 'text/html' or coalesce(latest_status, '') = '' and coalesce(latest_mimetype, '') = '' and kind in ('article', 'podcast') and (source like '%sitemap%' or source like '%feed%'))"""
_LISTED = "list_filter(list_transform(string_split(authors, ';'), lambda a: trim(a)), lambda a: a <> '')"
SQL = {
    "s8_shards": "select host, unnest(generate_series(a, greatest(a, b)))::int as year from (select host, min(left(first_seen_ts, 4))::int as a, max(left(last_seen_ts, 4))::int as b from url_records where regexp_full_match(first_seen_ts, '[0-9]{14}') and regexp_full_match(last_seen_ts, '[0-9]{14}') group by 1)",
    "s15_subjects": "select subject, count(*) as n from (select trim(unnest(string_split(subject, ';'))) as subject from podcast_metadata) where subject <> '' group by 1",
    "s23_players": "select mp3_url, player_url, min(seq) as seq from podcast_metadata where player_url <> '' and mp3_url <> '' group by 1, 2",
    "f3_fetchable": r"select coalesce(regexp_matches(url, 'sitemap.*\.xml(\.gz)?$', 'i') or contains(latest_mimetype, 'xml') and contains(url, 'sitemap'), false) as sitemap, kind, count(*) as n from url_records where (coalesce(latest_status, '') in ('', '-') or latest_status like '2__') and coalesce(last_seen_ts, '') <> '' group by 1, 2",
    "f5_years": "select left(first_seen_ts, 4) as year, host, count(*) as n from url_records where left(first_seen_ts, 4) between '2012' and '2016' group by 1, 2",
    "f6_junk": "select seq, id from site_records where kind = 'project' and regexp_full_match(regexp_extract(id, '([^/:]+)$', 1), 'embed|promo|lakes|coast') or kind = 'liveblog' and lower(title) = 'headline'",
    "f21_downloads": "select url, max(seq) as seq from enriched e where http_status = '200' and url <> '' and wayback_url <> '' and not exists (select 1 from site_records s where s.url = e.url) group by 1",
    "f25_path_sensitive": "select show_slug, count(*) <> count(distinct regexp_extract(coalesce(mp3_url, ''), '([^/]*)$', 1)) as path_sensitive, count(*) as files from podcast_metadata group by 1",
    "f32_month": "select seq, date, title from site_records where year = 2016 and date like '2016-11%'",
    "a16_last_episodes": "select identifier, seq, title from (select *, row_number() over (partition by identifier order by seq desc) as nth from podcast_metadata where identifier <> '') where nth = 1",
    "a22_fetch_summary": "select kind, http_status, count(*) as n, count(error) as errors, grouping(kind, http_status)::int as level from enriched group by cube (kind, http_status)",
    "a26_categories": "select case when kind = 'methodology' then 'article' else coalesce(kind, '(unknown)') end as category, case when left(date, 4) = year::varchar and length(date) >= 7 then left(date, 7) end as month, count(*) as n from site_records group by 1, 2",
    "a28_outcomes": "select count(*) filter (coalesce(error, '') = '') as recovered, count(*) filter (coalesce(error, '') <> '') as errored from enriched",
    "a30_first_seen": f"select {_AUDIO} as audio, min(seq) as seq from podcast_metadata where mp3_url <> '' group by 1",
    "a31_byline_records": f"select distinct slug, seq from {_CREDITS}",
    "a36_curation": f"select count(*) as rows_in, count(*) filter ({_KEPT}) as kept, count(distinct rollup_key) filter ({_KEPT}) as rows_out from url_records",
    "j10_archived": "with l as (select url, max(seq) as last from enriched where http_status = '200' and wayback_url is not null group by 1) select s.seq, coalesce(e.wayback_url, '') as archive_url from site_records s left join l on s.url = l.url left join enriched e on e.seq = l.last",
    "j17_review": "with r as (select canonical_key, arg_min(rollup_key, seq) as rollup_key, min(seq) as seq from curated group by 1), l as (select rollup_key, max(seq) as last from enriched group by 1) select canonical_key, r.seq, e.seq as fetch_seq, http_status from r left join l using (rollup_key) left join enriched e on e.seq = l.last",
    "j18_shows": "select seq, case when starts_with(identifier, 'tallyboard-model-talk') then 'tallyboard-model-talk' when starts_with(identifier, 'tallyboard-hot-streak') then 'tallyboard-hot-streak' when starts_with(identifier, 'tallyboard-board-politics') then 'tallyboard-board-politics' when starts_with(identifier, 'tallyboard') then 'tallyboard' end as show from podcast_metadata",
    "u18_enclosures": r"select seq, case when regexp_extract(mp3_url, '([A-Z]{3}\d{8,})', 1) <> '' then 'https://audio.castwell.example/' || regexp_extract(mp3_url, '([A-Z]{3}\d{8,})', 1) || '.mp3' else split_part(mp3_url, '?', 1) end as enclosure, regexp_extract(mp3_url, '([A-Z]{3}\d{8,})', 1) as episode from podcast_metadata",
    "u45_plain_text": r"""select doc_id, md5(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(text, '<!--(?s:.*?)-->', '', 'g'), '<[/a-zA-Z][^<>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\n{3,}', chr(10) || chr(10), 'g')) as text_md5 from documents""",
    "u52_item_metadata": rf"""select seq, name, value from (select seq, unnest(['title', 'creator', 'date', 'mediatype', 'year']) as name, unnest([coalesce(title, ''), coalesce(creator, ''), {_SITE}, coalesce(mediatype, ''), case when regexp_matches(coalesce(date, ''), '^(?:20|19)\d\d(?:\D|$)') then date[1:4] else '' end]) as value from podcast_metadata) where value <> ''""",
    "u57_display": f"select seq, case when len({_LISTED}) > 0 then array_to_string({_LISTED}, ', ') else byline end as shown, len(list_distinct({_LISTED}))::int as distinct_authors from site_records",
    "n13_properties": "select event_id, coalesce(json_extract_string(props, '$.k'), json_extract_string(props, '$.page'), 'none') as found from events",
    "n16_extensions": rf"""select coalesce(case latest_mimetype when 'text/html' then '.html' when 'application/xhtml+xml' then '.html' when 'application/pdf' then '.pdf' when 'image/png' then '.png' end, nullif(regexp_extract({path_sql("regexp_replace(regexp_replace(url, '^[[:space:]]+', ''), '[[:space:]]+$', '')")}, '(\.[a-z0-9]{{2,5}})$', 1), ''), '.bin') as extension, count(*) as n from url_records group by 1""",
    "o3_all_groups": "select canonical_key, count(*) as n from url_records group by 1 having count(*) > 1 order by 2 desc, min(seq)",
    "o3_largest_groups": "select canonical_key, count(*) as n from url_records group by 1 having count(*) > 1 order by 2 desc, min(seq) limit 100",
    "o11_kind_order": "select kind, count(*) as n from site_records group by 1",
    "o12_entries": "select seq, date from site_records order by nullif(date, '') desc nulls last, seq desc limit 250",
    "o15_sample": "select seq, id from site_records order by md5(seq || '/7'), seq limit 10",
    "x1_sightings": " union all ".join(f"select '{t}' as tab, count(*) as n, count(url) as with_url, count(distinct url) as urls from {t}" for t in ("url_records", "curated", "enriched", "feed_entries", "site_records")),
}
QUERIES = {n: f for n, f in globals().items() if n in SQL}
