"""The published record of a page and what is made of all records: totals, routes, orders; repairs written back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, titles, urls
from ..operators.choose import first_rows
from ..operators.orders import entry_order, episode_order
from ..operators.repairs import fill_blanks, take_longer
from ..operators.skew import look_up
from ..session import computed, filled, table
from .index import path_sql
from .site import SQL as SITE_SQL
from .site import j2_enrichment
from .values import ROOT
from .values import SQL as VALUE_SQL

PAGE = 250


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, id, title, byline, authors, year, date, kind, url) of every curated page that has an address.

    The link is to the earliest capture known of the page, else to the snapshot of its fetch, else to any capture; audio is
    linked where it plays. Title, byline and date are those of the best fetch, cleaned; a page without a fetch is dated by
    its first capture, one without a title has that of its address.
    """
    fetch = table(spark, sf_dir, "enriched").select(F.col("seq").alias("enriched_seq"), F.col("url").alias("e_url"), F.col("title").alias("e_title"), F.col("byline").alias("e_byline"), "published_at", "snapshot_timestamp")
    found = j2_enrichment(spark, sf_dir).select("seq", "enriched_seq").join(fetch, "enriched_seq", "left")
    pages = table(spark, sf_dir, "curated").select("seq", F.col("rollup_key").alias("id"), "kind", F.coalesce("url", F.lit("")).alias("own"), F.coalesce(filled("first_seen_ts"), filled("last_seen_ts"), F.lit("")).alias("earliest"))
    rows, fetched, audio = pages.join(found, "seq"), F.col("enriched_seq").isNotNull(), F.coalesce(F.col("kind"), F.lit("")) == "podcast"
    first = urls.archive_url(F.col("earliest"), F.col("own"), ROOT)
    second = F.when(fetched & ~audio, urls.archive_url(F.col("snapshot_timestamp"), F.coalesce(F.nullif("e_url", F.lit("")), F.col("own")), ROOT)).otherwise("")
    third = F.when((F.col("own") != "") & ~audio, F.concat(F.lit(ROOT), F.col("own"))).otherwise("")
    link = F.coalesce(*[F.nullif(x, F.lit("")) for x in (first, second, third, F.col("own"))])
    rows = computed(rows, {"url": link, "clean": titles.clean_title(F.coalesce("e_title", F.lit(""))), "date": dates.site_date(F.when(fetched, F.coalesce("published_at", F.lit(""))).otherwise(F.col("earliest"))), "names": titles.authors_of(F.coalesce("e_byline", F.lit("")))})
    made = F.coalesce(F.nullif("clean", F.lit("")), F.nullif(titles.last_segment_title(urls.path(F.col("own"))), F.lit("")), F.lit("(untitled)"))
    year = F.coalesce(dates.year_of(F.col("date")), urls.year_in_path(F.col("own")))
    return rows.filter("url is not null").select("seq", "id", made.alias("title"), titles.joined_names(F.col("names")).alias("byline"), "names", year.alias("year"), "date", "kind", "url")


def n19_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records, authors as one text."""
    return _records(spark, sf_dir).withColumn("names", F.array_join("names", "; ")).withColumnRenamed("names", "authors")


def k6_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the site says of its records on every page: how many there are, in all and of each kind."""
    return _records(spark, sf_dir).groupBy(F.coalesce("kind", F.lit("")).alias("kind")).agg(F.count("*").alias("total"), F.max("year").alias("latest_year"), F.count_if(F.col("byline") != "").alias("credited"))


def k7_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series of all episodes, blank ones left out, each with its number of episodes of which the last row stands."""
    last = first_rows(table(spark, sf_dir, "podcast_metadata").filter("identifier <> ''"), ["identifier"], [F.desc("seq")])
    return last.filter(filled("show_slug").isNotNull()).groupBy(F.trim("show_slug").alias("series")).agg(F.count("*").alias("total"))


def k10_sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every route of the site once: fixed ones, years, months, bylines and series."""
    rows = _records(spark, sf_dir)
    fixed = spark.createDataFrame([(r,) for r in STATIC_ROUTES], "route string")
    years = rows.filter("year is not null").select(F.concat(F.lit("/year/"), F.col("year").cast("string")))
    months = rows.filter(F.col("date").rlike(r"^\d{4}-\d{2}")).select(F.concat(F.lit("/year/"), F.left("date", F.lit(4)), F.lit("/"), F.substring("date", 6, 2)))
    shows = table(spark, sf_dir, "podcast_metadata").filter(filled("show_slug").isNotNull()).select(F.concat(F.lit("/podcast/"), F.trim("show_slug")))
    return fixed.union(years).union(months).union(shows).distinct()


def k13_bylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """enriched with its blank bylines filled from the feed's earliest credited entry of the same address; nothing else changes."""
    feed = first_rows(table(spark, sf_dir, "feed_entries").filter((F.col("url") != "") & filled("byline").isNotNull()), ["url"], [F.asc("seq")]).select("url", F.col("byline").alias("new"))
    rows = look_up(table(spark, sf_dir, "enriched").select("seq", "url", "byline"), feed, ["url"])
    return rows.select("seq", fill_blanks(F.col("byline"), F.col("new")).alias("byline"), (fill_blanks(F.col("byline"), F.col("new")).eqNullSafe(F.col("byline")) == F.lit(False)).alias("changed"))


def k13_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """enriched with dates that the feed's earliest dated entry of the same address gives more fully."""
    feed = first_rows(table(spark, sf_dir, "feed_entries").filter((F.col("url") != "") & filled("published_at").isNotNull()), ["url"], [F.asc("seq")]).select("url", F.col("published_at").alias("new"))
    rows = look_up(table(spark, sf_dir, "enriched").select("seq", "url", "published_at"), feed, ["url"])
    return rows.select("seq", take_longer(F.col("published_at"), F.col("new")).alias("published_at"))


def k14_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each page after its fetches are written over it one by one: the whole row of the last, and how many there were."""
    rows = table(spark, sf_dir, "enriched").filter("rollup_key is not null")
    at = F.col("seq")
    return rows.groupBy("rollup_key").agg(F.count("*").alias("writes"), F.max("seq").alias("seq"), *[F.max_by(c, at).alias(c) for c in ("url", "http_status", "error", "snapshot_timestamp")])


def a20_article_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct articles of each show with the seq that orders them: one row for each, so that no list grows long."""
    rows = table(spark, sf_dir, "podcast_metadata").filter(filled("show_slug").isNotNull() & filled("source_article_url").isNotNull())
    return rows.groupBy(F.trim("show_slug").alias("show_slug"), F.trim("source_article_url").alias("article")).agg(F.min("seq").alias("first"))


def s14_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each show with the number of its articles and the first of them, in the order of their titles."""
    lists = a20_article_lists(spark, sf_dir)
    return lists.groupBy("show_slug").agg(F.count("*").alias("articles"), F.min_by("article", "first").alias("first_article"), F.min("first").alias("first")).orderBy(F.lower("show_slug"), "first")


def j11_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of each audio file from its name, its players, its articles and the feed.

    The file's name may give show, date and bit rate. The article is that of the file, else the only one of its episode id.
    A date that isn't whole is taken from the article's first feed entry.
    """
    rows = table(spark, sf_dir, "podcast_metadata").filter(filled("mp3_url").isNotNull())
    files = rows.groupBy("mp3_url").agg(
        F.min_by("player_url", F.when(filled("player_url").isNotNull(), F.col("seq"))).alias("player_url"),
        F.min_by("source_article_url", F.when(filled("source_article_url").isNotNull(), F.col("seq"))).alias("own_article"),
        F.min_by(F.upper(F.trim("megaphone_id")), F.when(filled("megaphone_id").isNotNull(), F.col("seq"))).alias("episode"),
        F.min_by("date", F.when(filled("date").isNotNull(), F.col("seq"))).alias("own_date"),
    )
    name = F.regexp_extract(urls.path(F.col("mp3_url")), r"([^/]*)$", 1)
    of_name = lambda n: F.nullif(F.regexp_extract(name, NAMED_FILE, n), F.lit(""))
    known = rows.filter(filled("megaphone_id").isNotNull() & filled("source_article_url").isNotNull())
    single = known.groupBy(F.upper(F.trim("megaphone_id")).alias("episode")).agg(F.min("source_article_url").alias("a"), F.max("source_article_url").alias("b")).filter("a = b").select("episode", F.col("a").alias("episode_article"))
    feed = first_rows(table(spark, sf_dir, "feed_entries").filter((F.col("url") != "") & filled("published_at").isNotNull()), ["url"], [F.asc("seq")]).select(F.col("url").alias("article"), "published_at")
    with_article = look_up(files, single, ["episode"]).withColumn("article", F.coalesce("own_article", "episode_article"))
    dated = look_up(with_article, feed, ["article"])
    date = F.coalesce(of_name(2), F.col("own_date"))
    whole = F.coalesce(date, F.lit("")).rlike(r"^\d{4}-\d{2}-\d{2}")
    return dated.select("mp3_url", "player_url", "episode", "article", of_name(1).alias("show"), of_name(3).alias("bitrate"), F.when(~whole & F.col("published_at").isNotNull(), F.col("published_at")).otherwise(date).alias("date"))


def o12_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of the entries in each order that the table offers."""
    rows = table(spark, sf_dir, "site_records").select("seq", "date", "title", F.coalesce(F.nullif(F.array_join(titles.authors_of(F.coalesce("authors", F.lit(""))), ", "), F.lit("")), F.col("byline")).alias("byline"))
    return _pages(rows, entry_order, ("date", "title", "byline"))


def o13_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of the episodes in each order that the table offers."""
    return _pages(table(spark, sf_dir, "podcast_metadata").select("seq", "date", "title", F.col("show_slug").alias("series")), episode_order, ("date", "title", "series"))


def _pages(rows: DataFrame, order, columns: tuple[str, ...]) -> DataFrame:
    parts = [rows.orderBy(*order(c, down)).limit(PAGE).select(F.lit(f"{c} {'down' if down else 'up'}").alias("sorted_by"), "seq") for c in columns for down in (False, True)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def o9_byline_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every credited name with its number of records, in the order of a reader's alphabet."""
    names = _records(spark, sf_dir).select(F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    return names.orderBy(F.collate("name", "UNICODE"), "name")


#: Pages of the site that no record makes, and the form of the names of audio files.
STATIC_ROUTES = ["/", "/about", "/byline", "/podcast", "/search", "/year"]
NAMED_FILE = r"^([A-Za-z][A-Za-z0-9-]*?)[-_](\d{4}-\d{2}-\d{2})[-_.](?:.*?(\d{2,3})k?)?\.mp3$"
_SITE_DATE = VALUE_SQL["d1_dates"].split(" as iso,")[1].split(" as site,")[0].strip()
_CLEAN = VALUE_SQL["u26_titles"].split("select seq, ")[1].split(" as clean")[0]
_PATH_YEAR = f"list_max(list_filter(list_transform(list_filter(regexp_extract_all({path_sql('url')}, '\\d+'), lambda y: regexp_full_match(y, '20[0-2]\\d')), lambda y: y::int), lambda y: y between 2008 and 2029))"


def _link_sql(ts: str, url: str) -> str:
    return f"case when coalesce({ts}, '') = '' or coalesce({url}, '') = '' then null else '{ROOT}' || {ts} || '/' || {url} end"


_FILLED = lambda c: f"nullif(nullif(trim({c}), ''), '-')"
_RECORDS = f"""j as ({SITE_SQL["j2_enrichment"]}), au as ({SITE_SQL["u29_authors"]}), ti as ({VALUE_SQL["u26_titles"]}), ut as ({VALUE_SQL["u35_url_titles"]}),
    c as (select seq, rollup_key as id, kind, coalesce(url, '') as own, coalesce(case when {_FILLED("first_seen_ts")} is not null then first_seen_ts end, case when {_FILLED("last_seen_ts")} is not null then last_seen_ts end, '') as earliest from curated),
    m as (select c.*, j.enriched_seq, e.url as e_url, e.snapshot_timestamp, case when j.enriched_seq is null then c.earliest else coalesce(e.published_at, '') end as published_at, c.own as url from c join j using (seq) left join enriched e on e.seq = j.enriched_seq),
    d as (select *, {_SITE_DATE} as date, {_PATH_YEAR} as path_year from m),
    r as (select d.seq, id, coalesce(nullif(ti.clean, ''), nullif(ut.url_title, ''), '(untitled)') as title, coalesce(au.byline_clean, '') as byline, coalesce(au.authors, '') as authors,
        coalesce(case when regexp_matches(date, '^\\d{{4}}') then date[1:4]::int end, path_year) as year, date, kind,
        coalesce({_link_sql("earliest", "own")}, case when d.enriched_seq is not null and coalesce(kind, '') <> 'podcast' then {_link_sql("snapshot_timestamp", "coalesce(nullif(e_url, ''), own)")} end, case when own <> '' and coalesce(kind, '') <> 'podcast' then '{ROOT}' || own end, nullif(own, '')) as url
        from d left join ti on ti.seq = d.enriched_seq left join au on au.seq = d.enriched_seq left join ut on ut.seq = d.seq),
    records as (select * from r where url is not null)"""
_FEED = "f as (select url, {c} as new from (select *, row_number() over (partition by url order by seq) as nth from feed_entries where url <> '' and " + _FILLED("{c}") + " is not null) where nth = 1)"
_NAME = f"regexp_extract({path_sql('mp3_url')}, '([^/]*)$', 1)"
_OF_NAME = lambda n: f"nullif(regexp_extract({_NAME}, '{NAMED_FILE}', {n}), '')"
_LISTS = f"select trim(show_slug) as show_slug, trim(source_article_url) as article, min(seq) as first from podcast_metadata where {_FILLED('show_slug')} is not null and {_FILLED('source_article_url')} is not null group by 1, 2"
_SEQ_OF = lambda c: f"arg_min({c}, seq) filter (where {_FILLED(c)} is not null)"
SQL = {
    "n19_records": f"with {_RECORDS} select * from records",
    "k6_totals": f"with {_RECORDS} select coalesce(kind, '') as kind, count(*) as total, max(year) as latest_year, count(*) filter (byline <> '') as credited from records group by 1",
    "k7_episodes": f"with l as (select * from (select *, row_number() over (partition by identifier order by seq desc) as nth from podcast_metadata where identifier <> '') where nth = 1) select trim(show_slug) as series, count(*) as total from l where {_FILLED('show_slug')} is not null group by 1",
    "k10_sitemap": f"""with {_RECORDS} select unnest([{", ".join(f"'{r}'" for r in STATIC_ROUTES)}]) as route union select '/year/' || year from records where year is not null union select '/year/' || date[1:4] || '/' || date[6:7] from records where regexp_matches(date, '^\\d{{4}}-\\d{{2}}')
        union select '/podcast/' || trim(show_slug) from podcast_metadata where {_FILLED("show_slug")} is not null""",
    "k13_bylines": f"with {_FEED.format(c='byline')} select seq, case when coalesce(trim(byline), '') = '' then coalesce(new, byline) else byline end as byline, coalesce(trim(byline), '') = '' and new is not null as changed from enriched left join f using (url)",
    "k13_dates": f"with {_FEED.format(c='published_at')} select seq, case when length(coalesce(new, '')) > length(coalesce(published_at, '')) then new else published_at end as published_at from enriched left join f using (url)",
    "k14_upserted": "with w as (select *, count(*) over (partition by rollup_key) as writes, row_number() over (partition by rollup_key order by seq desc) as nth from enriched where rollup_key is not null) select rollup_key, writes, seq, url, http_status, error, snapshot_timestamp from w where nth = 1",
    "a20_article_lists": _LISTS,
    "s14_catalogue": f"select show_slug, count(*) as articles, arg_min(article, first) as first_article, min(first) as first from ({_LISTS}) group by 1",
    "j11_context": f"""with p as (select * from podcast_metadata where {_FILLED("mp3_url")} is not null),
        f as (select mp3_url, {_SEQ_OF("player_url")} as player_url, {_SEQ_OF("source_article_url")} as own_article, upper(trim({_SEQ_OF("megaphone_id")})) as episode, {_SEQ_OF("date")} as own_date from p group by 1),
        s as (select upper(trim(megaphone_id)) as episode, min(source_article_url) as episode_article from p where {_FILLED("megaphone_id")} is not null and {_FILLED("source_article_url")} is not null group by 1 having count(distinct source_article_url) = 1),
        e as (select url as article, published_at from (select *, row_number() over (partition by url order by seq) as nth from feed_entries where url <> '' and {_FILLED("published_at")} is not null) where nth = 1),
        g as (select f.*, coalesce(own_article, episode_article) as article, coalesce({_OF_NAME(2)}, own_date) as held from f left join s using (episode))
        select mp3_url, player_url, episode, article, {_OF_NAME(1)} as show, {_OF_NAME(3)} as bitrate, case when not regexp_matches(coalesce(held, ''), '^\\d{{4}}-\\d{{2}}-\\d{{2}}') and published_at is not null then published_at else held end as date from g left join e using (article)""",
}
QUERIES = {n: globals()[n] for n in ("n19_records", "k6_totals", "k7_episodes", "k10_sitemap", "k13_bylines", "k13_dates", "k14_upserted", "a20_article_lists", "s14_catalogue", "j11_context", "o12_pages", "o13_pages", "o9_byline_index")}
