"""Queries of the published site: joins with side tables, resolved articles, facets, sorted lists and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import titles, urls
from ..functions.text import strip_blank
from ..operators.choose import first_rows, last_row_wins, unique_or_nothing
from ..operators.lookups import lookup_with_fallback, overlay, pending
from ..operators.resolve import resolve_articles
from ..operators.search import inverted_index, matches
from ..operators.skew import look_up
from ..session import computed, table
from .index import SQL as INDEX_SQL
from .index import a8_best_enriched
from .values import SQL as VALUE_SQL

LEGACY = "article:wp/"


def _key(df: DataFrame, url: str, name: str = "key") -> DataFrame:
    return urls.classified(df, strip_blank(F.col(url)), "c").select(*df.columns, F.col("c.rollup_key").alias(name))


def j2_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = _key(table(spark, sf_dir, "curated").select("seq", "rollup_key", "url"), "url")
    best = a8_best_enriched(spark, sf_dir).withColumnRenamed("seq", "enriched_seq")
    return lookup_with_fallback(left, best, [F.col("rollup_key"), F.col("key")], "rollup_key", "enriched_seq").select("seq", "enriched_seq", "found_by")


def _episode_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, mp3_url): of the episodes that name an article, the last one for each page."""
    rows = _key(table(spark, sf_dir, "podcast_metadata").filter("source_article_url <> ''").select("seq", "source_article_url", "mp3_url"), "source_article_url")
    return last_row_wins(rows, ["key"], "seq").select("key", "mp3_url")


def j3_url_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "site_records").select("seq", "id", "url").alias("r")
    items = _episode_pages(spark, sf_dir)
    return rows.join(items, F.col("id") == F.col("key"), "left").select("seq", overlay(F.col("url"), F.col("mp3_url")).alias("url"))


def j4_published_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    episodes = _key(table(spark, sf_dir, "podcast_metadata").filter("identifier <> ''").select("seq", "identifier", "source_article_url"), "source_article_url")
    known = table(spark, sf_dir, "curated").select(F.col("rollup_key").alias("key"))
    return first_rows(episodes.join(known, "key", "left_semi"), ["identifier"], [F.asc("seq")]).select("identifier", "seq")


def j6_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "podcast_metadata").filter("source_article_url <> ''").select("seq", titles.hash_key("", F.col("source_article_url"), 16).alias("file"))
    pages = last_row_wins(table(spark, sf_dir, "enriched").select(F.col("seq").alias("enriched_seq"), titles.hash_key("", F.coalesce("url", F.lit("")), 16).alias("file")), ["file"], "enriched_seq")
    return refs.join(pages, "file", "left").select("seq", "enriched_seq")


def j7_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "curated").select("rollup_key", "seq")
    return pending(targets, table(spark, sf_dir, "enriched"), "rollup_key", F.col("http_status") == "200")


def j9_first_story_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    related = _key(table(spark, sf_dir, "podcast_metadata").filter("source_article_url <> ''").select("show_slug", "source_article_url"), "source_article_url")
    stories = last_row_wins(table(spark, sf_dir, "enriched").select(F.col("rollup_key").alias("key"), "seq", "published_at"), ["key"], "seq")
    return related.join(stories, "key").filter("published_at <> ''").groupBy("show_slug").agg(F.min("published_at").alias("first_date"), F.count("*").alias("stories"))


def j16_kind_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.create_map(*[F.lit(x) for pair in (("article", "Articles"), ("liveblog", "Live blogs"), ("podcast", "Podcasts"), ("video", "Videos"), ("project", "Interactives")) for x in pair])
    rows = table(spark, sf_dir, "curated")
    return rows.groupBy(F.coalesce(F.try_element_at(labels, F.col("kind")), F.col("kind")).alias("label")).agg(F.count("*").alias("n"))


def j20_best_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("tab"), "seq", "url", "title", "byline", "published_at") for t in ("enriched", "feed_entries")]
    rows = parts[0].unionByName(parts[1]).filter("url <> ''")
    filled = lambda c: F.coalesce(F.col(c) != "", F.lit(False)).cast("int")
    order = [F.length(F.coalesce("title", F.lit(""))).desc(), filled("byline").desc(), filled("published_at").desc(), F.asc("tab"), F.asc("seq")]
    return first_rows(rows, ["url"], order).select("url", "tab", "seq")


def j21_backfilled_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    episodes = table(spark, sf_dir, "podcast_metadata").filter("coalesce(date, '') in ('', '-')").select("seq", "title")
    feed = table(spark, sf_dir, "feed_entries").filter("title is not null and published_at is not null")
    known = unique_or_nothing(feed.select(F.explode(titles.plain_keys(F.col("title"))).alias("k"), "published_at"), F.col("k"), F.col("published_at"))
    keys = episodes.filter("title is not null").select("seq", F.explode(titles.plain_keys(F.col("title"))).alias("key"))
    dated = look_up(keys, known, ["key"]).groupBy("seq").agg(F.min("value").alias("date"))
    return episodes.select("seq").join(dated, "seq", "left")


def j22_overlaid(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = first_rows(table(spark, sf_dir, "feed_entries").filter("url <> ''"), ["url"], [F.desc("seq")]).select("url", F.col("title").alias("feed_title"), F.col("byline").alias("feed_byline"))
    rows = look_up(table(spark, sf_dir, "enriched").select("seq", "url", "title", "byline"), feed, ["url"])
    return rows.select("seq", overlay(F.col("title"), F.col("feed_title")).alias("title"), overlay(F.col("byline"), F.col("feed_byline")).alias("byline"))


def a11_resolved_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "site_records")
    return resolve_articles(rows, titles.title_key(F.col("title")), F.col("id").startswith(LEGACY))


def a13_project_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "site_records").filter("kind = 'project'").select("seq", "title", titles.drilldown_suffix(F.col("id")).alias("suffix"))
    shared = rows.filter("title is not null").groupBy("title").agg(F.count("*").alias("n")).filter("n > 1")
    joined = look_up(rows, shared, ["title"])
    add = F.col("n").isNotNull() & (F.col("suffix") != "") & ~F.contains(F.lower("title"), F.lower("suffix"))
    return joined.select("seq", F.when(add, F.concat("title", F.lit(": "), "suffix")).otherwise(F.col("title")).alias("title"))


def a17_chosen_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    transient = F.contains("error", F.lit("Reset")) | F.contains("error", F.lit("Timeout"))
    rank = F.when(F.col("http_status") == "200", 2).when(transient, 0).otherwise(1)
    return first_rows(table(spark, sf_dir, "enriched"), ["rollup_key"], [rank.desc(), F.desc("seq")]).select("rollup_key", "seq", "error")


def a19_unique_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "feed_entries")
    return unique_or_nothing(rows, titles.title_key(F.col("title")), F.col("published_at"))


def _credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, name, slug) of every author of site_records, by its clean byline."""
    rows = table(spark, sf_dir, "site_records").filter("byline is not null").select("seq", F.explode(titles.authors_of(F.col("byline"))).alias("name"))
    return rows.withColumn("slug", F.regexp_replace(F.regexp_replace(F.lower("name"), r"[^\p{L}\p{N}]+", "-"), "^-+|-+$", ""))


def a23_bylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _credits(spark, sf_dir).groupBy("slug").agg(F.min_by("name", "seq").alias("name"), F.count("*").alias("n"))


def a24_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.when(F.col("date").rlike(r"^\d{4}-\d{2}"), F.left("date", F.lit(7)))
    rows = table(spark, sf_dir, "site_records").select("year", F.when(F.left(month, F.lit(4)) == F.col("year").cast("string"), month).alias("month"))
    return rows.groupBy("year", "month").agg(F.count("*").alias("n"))


def a25_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "podcast_metadata").filter("show_slug <> ''")
    return rows.groupBy("show_slug").agg(F.count("*").alias("n"), F.min_by("title", "seq").alias("first_title")).orderBy(F.desc("n"), "show_slug")


def a27_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, t).agg(F.count("*").alias("n")) for t in ("site_records", "podcast_metadata", "curated", "enriched", "feed_entries")]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.agg(F.sum("n").alias("total"))


def a29_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "podcast_metadata").select("seq", titles.identifier(F.col("show_slug"), F.col("title")).alias("base"), F.coalesce("mp3_url", F.lit("")).alias("mp3"))
    shared = rows.groupBy("base").agg(F.count("*").alias("n")).filter("n > 1")
    made = F.when(F.col("n").isNotNull(), F.concat(F.left("base", F.lit(91)), F.lit("-"), F.left(F.sha2("mp3", 256), F.lit(8)))).otherwise(F.col("base"))
    return look_up(rows, shared, ["base"]).select("seq", made.alias("identifier"))


def a32_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "site_records")
    years = rows.filter("year is not null").select(F.concat(F.lit("/year/"), F.col("year").cast("string")).alias("route"))
    months = rows.filter(F.col("date").rlike(r"^\d{4}-\d{2}")).select(F.concat(F.lit("/year/"), F.left("date", F.lit(4)), F.lit("/"), F.substring("date", 6, 2)).alias("route"))
    names = _credits(spark, sf_dir).select(F.concat(F.lit("/byline/"), "slug").alias("route"))
    shows = table(spark, sf_dir, "podcast_metadata").filter("show_slug <> ''").select(F.concat(F.lit("/podcast/"), "show_slug").alias("route"))
    return years.distinct().union(months.distinct()).union(names.distinct()).union(shows.distinct())


def o4_all_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record in order; `o4_article_order` is its first thousand rows, as its SQL has them."""
    rows = table(spark, sf_dir, "site_records")
    return rows.orderBy(F.nullif("date", F.lit("")).asc_nulls_last(), F.col("title").asc_nulls_first(), "seq").select("seq", "date", "title")


def o4_article_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thousand records by date, blank dates last, then title."""
    rows = table(spark, sf_dir, "site_records")
    return rows.orderBy(F.nullif("date", F.lit("")).asc_nulls_last(), F.col("title").asc_nulls_first(), "seq").limit(1000).select("seq", "date", "title")


def o8_top_bylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _credits(spark, sf_dir).groupBy("slug").agg(F.count("*").alias("n"), F.min("seq").alias("first")).orderBy(F.desc("n"), "first", "slug").limit(10).select("slug", "n")


def o13_episode_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of episodes by date descending; blank dates count as after all others."""
    rows = table(spark, sf_dir, "podcast_metadata")
    return rows.orderBy(F.coalesce(F.nullif("date", F.lit("")), F.lit("￿")).desc(), F.col("title").asc_nulls_first(), "seq").limit(250).select("seq", "date")


def o16_second_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "curated").orderBy("kind", "url", "seq")
    return rows.offset(96).limit(96).select("seq", "kind", "url")


def x4_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "podcast_metadata")
    played = rows.filter(F.contains("player_url", F.lit("/player/"))).select(F.regexp_extract("player_url", r"[?&]src=([^&]+)", 1).alias("audio")).filter(F.contains("audio", F.lit("mp3")))
    return played.union(rows.filter("mp3_url <> ''").select("mp3_url")).select(urls.audio_url(F.col("audio")).alias("audio")).distinct()


def x5_unpublished(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "curated").select("rollup_key").distinct()
    return keys.exceptAll(table(spark, sf_dir, "site_records").select(F.col("id").alias("rollup_key")).distinct())


def f17_byline_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    rows = table(spark, sf_dir, "enriched")
    wanted = blank("error") & blank("byline") & F.col("kind").isin("article", "video", "methodology") & ~blank("url") & ~blank("snapshot_timestamp")
    return rows.select("seq", F.when(wanted, "byline").when((F.length("published_at") == 7) & (F.substring("published_at", 5, 1) == "-"), "date").when(~blank("error") | (blank("title") & blank("byline") & blank("published_at")), "failed").alias("why")).filter("why is not null")


def f28_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "site_records")
    text = F.lower(F.concat_ws(" ", "title", "byline", "date", "kind", "url"))
    return rows.filter(F.contains(text, F.lit("rating")) & F.col("kind").isin("article", "liveblog")).select("seq", "title")


def t1_word_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inverted_index(table(spark, sf_dir, "site_records"), "seq", ["title", "byline"]).groupBy("term", "field").agg(F.count("*").alias("records"), F.sum("n").alias("n"))


def t2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "site_records")
    found = matches(inverted_index(rows, "seq", ["title", "byline"]), "seq", ["ballots", "matter"])
    return rows.join(found, "seq").filter("kind in ('article', 'liveblog', 'project')").orderBy(F.col("date").asc_nulls_first(), "seq").limit(100).select("seq", "title", "date")


_KEY = VALUE_SQL["u9_classified"].split("select seq, ", 2)[2].rsplit(" as page", 1)[0]


def _key_sql(url: str) -> str:
    import re

    return "(" + re.sub(r"\burl\b(?!_)", url, _KEY) + ").rollup_key"


_BEST = INDEX_SQL["a8_best_enriched"]
_WIDE = r"trim(regexp_replace(byline, '\s+', ' ', 'g'))"
_SHOWN = rf"regexp_replace(case when regexp_extract({_WIDE}, '^\S+@\S+ \(([^)]+)\)$', 1) <> '' then regexp_extract({_WIDE}, '^\S+@\S+ \(([^)]+)\)$', 1) else {_WIDE} end, '^([-–—]+\s*|(edited by|written by|posted by|by)\s+)', '', 'i')"
_TITLED = r"array_to_string(list_transform(regexp_extract_all(lower(p), '(\p{L}+|\P{L}+)'), lambda w: upper(w[1]) || w[2:]), '')"
_NOBODY = "('" + "', '".join(titles.NO_PERSONS) + "')"
_STARTS = "^(" + "|".join(titles.NO_PERSON_STARTS) + ")"
_AUTHORS = rf"""(with s as (select seq, byline, generate_subscripts(parts, 1) as place, unnest(parts) as raw from (select seq, byline, regexp_split_to_array({_SHOWN}, '(?i)\s*(,\s*and\s+|,\s*|\s+and\s+|\s*/\s*|\s*\|\s*)\s*') as parts from {{table}} where byline is not null)),
    t as (select seq, place, regexp_replace(trim(raw, ' ' || chr(9) || chr(10)), '^[.,;\s]+|[.,;\s]+$', '', 'g') as p from s), c as (select seq, place, case when p = upper(p) and contains(p, ' ') then {_TITLED} else p end as name from t),
    f as (select * from c where name <> '' and not regexp_matches(name, '[0-9]') and lower(name) not in {_NOBODY} and not regexp_matches(lower(name), '{_STARTS}'))
    select seq, place, name, regexp_replace(regexp_replace(lower(name), '[^\p{{L}}\p{{N}}]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from (select *, row_number() over (partition by seq, lower(name) order by place) as nth from f) where nth = 1)"""
_CREDITS = _AUTHORS.replace("{table}", "site_records").replace("{{", "{").replace("}}", "}")
_TKEY = "lower(translate(trim(coalesce(title, '')), '‘’“”–—', '''''\"\"--'))"
_NORM = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_KEYS = f"""unnest(list_filter(list_distinct([{_NORM.format('title')}, {_NORM.format("regexp_replace(title, '^[^:]{1,40}:[[:space:]]*', '')")}]), lambda k: k <> ''))"""
_ORDER = "case when kind = 'article' then 1 else 0 end desc, case when byline <> '' then 1 else 0 end desc, case when contains(id, '-revision') then 0 else 1 end desc, case when contains(coalesce(url, ''), '?') then 0 else 1 end desc, length(id) desc, id desc, seq"
_SUFFIX = r"array_to_string(list_transform(regexp_extract_all(lower(array_to_string(string_split(replace(regexp_extract(id, '^project:[^/]+/(.+)$', 1), '-', ' '), '/'), ' / ')), '(\p{L}+|\P{L}+)'), lambda w: upper(w[1]) || w[2:]), '')"
_ID = r"regexp_replace(left(regexp_replace(regexp_replace(lower(concat_ws('-', show_slug, title)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 100), '-+$', '')"
_AUDIO = rf"regexp_replace(split_part(split_part(case when regexp_matches(audio, '^[a-z]+://') then audio else 'https://' || regexp_replace(audio, '^//', '') end, '#', 1), '?', 1), '\.mp$', '.mp3')"
_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
SQL = {
    "u29_authors": f"""with a as ({_AUTHORS.replace("{table}", "enriched").replace("{{", "{").replace("}}", "}")[1:-1]}), l as (select seq, list(name order by place) as names from a group by 1), e as (select seq, coalesce(names, []) as names from enriched left join l using (seq) where byline is not null)
        select seq, array_to_string(names, '; ') as authors, case when len(names) <= 1 then array_to_string(names, '') when len(names) = 2 then array_to_string(names, ' and ') else array_to_string(names[:-2], ', ') || ', and ' || names[-1] end as byline_clean, len(names)::int as n from e""",
    "j2_enrichment": f"""with e as ({_BEST}), c as (select seq, rollup_key, {_key_sql('url')} as key from curated)
        select c.seq, coalesce(a.seq, b.seq) as enriched_seq, case when a.seq is not null then 1 when b.seq is not null then 2 end as found_by from c left join e a on c.rollup_key = a.rollup_key left join e b on c.key = b.rollup_key""",
    "j3_url_override": f"""with p as (select key, arg_max(mp3_url, seq) as m from (select seq, mp3_url, {_key_sql('source_article_url')} as key from podcast_metadata where source_article_url <> '') where mp3_url is not null group by 1),
        l as (select key, max(seq) as last from (select seq, {_key_sql('source_article_url')} as key from podcast_metadata where source_article_url <> '') group by 1)
        select r.seq, coalesce(nullif(x.mp3_url, ''), r.url) as url from site_records r left join l on r.id = l.key left join podcast_metadata x on x.seq = l.last""",
    "j4_published_episodes": f"select identifier, min(seq) as seq from (select seq, identifier, {_key_sql('source_article_url')} as key from podcast_metadata where identifier <> '') where key in (select rollup_key from curated) group by 1",
    "j6_by_file": "select p.seq, e.last as enriched_seq from podcast_metadata p left join (select sha1(coalesce(url, '')) as file, max(seq) as last from enriched group by 1) e on left(sha1(p.source_article_url), 16) = left(e.file, 16) where p.source_article_url <> ''",
    "j7_pending": "select rollup_key, seq from curated c where not exists (select 1 from enriched e where e.rollup_key = c.rollup_key and http_status = '200')",
    "j9_first_story_dates": f"""with s as (select rollup_key, arg_max(seq, seq) as last from enriched group by 1)
        select show_slug, min(published_at) as first_date, count(*) as stories from (select show_slug, {_key_sql('source_article_url')} as key from podcast_metadata where source_article_url <> '') p join s on p.key = s.rollup_key join enriched e on e.seq = s.last where published_at <> '' group by 1""",
    "j16_kind_labels": "select case kind when 'article' then 'Articles' when 'liveblog' then 'Live blogs' when 'podcast' then 'Podcasts' when 'video' then 'Videos' when 'project' then 'Interactives' else kind end as label, count(*) as n from curated group by 1",
    "j20_best_references": """with r as (select 'enriched' as tab, seq, url, title, byline, published_at from enriched union all select 'feed_entries', seq, url, title, byline, published_at from feed_entries)
        select url, tab, seq from (select *, row_number() over (partition by url order by length(coalesce(title, '')) desc, case when byline <> '' then 1 else 0 end desc, case when published_at <> '' then 1 else 0 end desc, tab, seq) as nth from r where url <> '') where nth = 1""",
    "j21_backfilled_dates": f"""with u as (select k, min(published_at) as v from (select {_KEYS} as k, published_at from feed_entries where title is not null and published_at <> '') group by 1 having count(distinct published_at) = 1),
        e as (select seq, title from podcast_metadata where coalesce(date, '') in ('', '-')), d as (select seq, min(v) as date from (select seq, {_KEYS} as k from e where title is not null) x join u using (k) group by 1) select e.seq, d.date from e left join d using (seq)""",
    "j22_overlaid": """with f as (select url, max(seq) as last from feed_entries where url <> '' group by 1)
        select e.seq, coalesce(nullif(x.title, ''), e.title) as title, coalesce(nullif(x.byline, ''), e.byline) as byline from enriched e left join f using (url) left join feed_entries x on x.seq = f.last""",
    "a11_resolved_articles": f"""with r as (select seq, id, kind, url, coalesce(byline, '') as byline, {_TKEY} as t, left(date, 10) as d, starts_with(id, '{LEGACY}') as legacy from site_records),
        g as (select * from r where kind in ('article', 'video') and t <> '' and d <> ''),
        k as (select t, d, case when count(distinct nullif(byline, '')) <= 1 then 'one' when bool_or(legacy) and not bool_and(legacy) then 'mixed' else 'each' end as way from g group by 1, 2),
        x as (select g.*, way, row_number() over (partition by t, d order by {_ORDER}) as nth, row_number() over (partition by t, d, legacy order by {_ORDER}) as old_nth, row_number() over (partition by t, d, byline order by {_ORDER}) as own_nth from g join k using (t, d))
        select a.seq, coalesce(b.seq, a.seq) as byline_seq from x a left join x b on a.way = 'mixed' and b.t = a.t and b.d = a.d and b.legacy and b.old_nth = 1 where a.way in ('one', 'mixed') and a.nth = 1
        union all select seq, seq from x where way = 'each' and own_nth = 1 union all select seq, seq from r where not coalesce(kind in ('article', 'video') and t <> '' and d <> '', false)""",
    "a13_project_titles": f"""with r as (select seq, title, {_SUFFIX} as suffix, count(*) over (partition by title) as n from site_records where kind = 'project')
        select seq, case when title is not null and n > 1 and suffix <> '' and not contains(lower(title), lower(suffix)) then title || ': ' || suffix else title end as title from r""",
    "a17_chosen_fetch": "select rollup_key, seq, error from (select *, row_number() over (partition by rollup_key order by case when http_status = '200' then 2 when contains(error, 'Reset') or contains(error, 'Timeout') then 0 else 1 end desc, seq desc) as nth from enriched) where nth = 1",
    "a19_unique_dates": f"select key, min(published_at) as value from (select {_TKEY} as key, published_at from feed_entries) where key <> '' and published_at <> '' group by 1 having count(distinct published_at) = 1",
    "a23_bylines": f"select slug, arg_min(name, seq) as name, count(*) as n from {_CREDITS} group by 1",
    "a24_months": "select year, case when regexp_matches(date, '^[0-9]{4}-[0-9]{2}') and left(date, 4) = year::varchar then left(date, 7) end as month, count(*) as n from site_records group by 1, 2",
    "a25_series": "select show_slug, count(*) as n, arg_min(title, seq) filter (title is not null or true) as first_title from podcast_metadata where show_slug <> '' group by 1",
    "a27_total": "select (select count(*) from site_records) + (select count(*) from podcast_metadata) + (select count(*) from curated) + (select count(*) from enriched) + (select count(*) from feed_entries) as total",
    "a29_identifiers": f"with r as (select seq, {_ID} as base, coalesce(mp3_url, '') as mp3 from podcast_metadata) select seq, case when count(*) over (partition by base) > 1 then left(base, 91) || '-' || left(sha256(mp3), 8) else base end as identifier from r",
    "a32_routes": f"""select distinct '/year/' || year as route from site_records where year is not null union all select distinct '/year/' || left(date, 4) || '/' || date[6:7] from site_records where regexp_matches(date, '^[0-9]{{4}}-[0-9]{{2}}')
        union all select distinct '/byline/' || slug from {_CREDITS} union all select distinct '/podcast/' || show_slug from podcast_metadata where show_slug <> ''""",
    "o4_all_articles": "select seq, date, title from site_records order by nullif(date, '') nulls last, title nulls first, seq",
    "o4_article_order": "select seq, date, title from site_records order by nullif(date, '') nulls last, title nulls first, seq limit 1000",
    "o8_top_bylines": f"select slug, count(*) as n from {_CREDITS} group by 1 order by 2 desc, min(seq), slug limit 10",
    "o13_episode_order": "select seq, date from podcast_metadata order by coalesce(nullif(date, ''), chr(65535)) desc, title nulls first, seq limit 250",
    "o16_second_page": "select seq, kind, url from curated order by kind, url, seq limit 96 offset 96",
    "x4_audio": f"select distinct {_AUDIO} as audio from (select regexp_extract(player_url, '[?&]src=([^&]+)', 1) as audio from podcast_metadata where contains(player_url, '/player/') union all select mp3_url from podcast_metadata where mp3_url <> '') where contains(audio, 'mp3')",
    "x5_unpublished": "select rollup_key from (select distinct rollup_key from curated) except select id from site_records",
    "f17_byline_gaps": """select seq, why from (select seq, case when coalesce(trim(error), '') = '' and coalesce(trim(byline), '') = '' and kind in ('article', 'video', 'methodology') and coalesce(trim(url), '') <> '' and coalesce(trim(snapshot_timestamp), '') <> '' then 'byline'
        when length(published_at) = 7 and published_at[5] = '-' then 'date' when coalesce(trim(error), '') <> '' or coalesce(trim(title), '') = '' and coalesce(trim(byline), '') = '' and coalesce(trim(published_at), '') = '' then 'failed' end as why from enriched) where why is not null""",
    "f28_listed": "select seq, title from site_records where contains(lower(concat_ws(' ', title, byline, date, kind, url)), 'rating') and kind in ('article', 'liveblog')",
    "t1_word_index": f"""with w as (select 'title' as field, seq, unnest({_WORDS.format('title')}) as term from site_records union all select 'byline', seq, unnest({_WORDS.format('byline')}) from site_records)
        select term, field, count(distinct seq) as records, count(*) as n from w group by 1, 2""",
    "t2_search": f"""with w as (select seq, unnest(list_concat({_WORDS.format('title')}, {_WORDS.format('byline')})) as term from site_records), m as (select seq from w group by 1 having bool_or(starts_with(term, 'ballots') or levenshtein(term, 'ballots') <= 1) and bool_or(starts_with(term, 'matter') or levenshtein(term, 'matter') <= 1))
        select seq, title, date from site_records where seq in (select seq from m) and kind in ('article', 'liveblog', 'project') order by date nulls first, seq limit 100""",
}
QUERIES = {n: f for n, f in globals().items() if n in SQL}
