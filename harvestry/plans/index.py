"""Queries of the merged index, pages, duplicates and corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import surt_key
from ..operators.captures import duplicate_groups, merged_index, project_address, qualifies, rolled_up
from ..operators.choose import first_rows, most_frequent, spaced_days, top_counts
from ..operators.deliveries import post_key
from ..session import filled, table
from .problems import _BLANKS, _POST

PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def strip_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_BLANKS}+', ''), '{_BLANKS}+$', '')"


def host_sql(c: str) -> str:
    return f"lower(regexp_replace(regexp_replace(regexp_extract({c}, '{PARTS}', 2), '^.*@', ''), ':[0-9]*$', ''))"


def path_sql(c: str) -> str:
    return f"regexp_extract({c}, '{PARTS}', 3)"


def query_sql(c: str) -> str:
    return f"regexp_extract({c}, '{PARTS}', 4)"


def surt_sql(c: str) -> str:
    s = strip_sql(c)
    return f"lower(array_to_string(list_reverse(string_split({host_sql(s)}, '.')), ',') || ')/' || regexp_replace({path_sql(s)}, '^/+', '') || case when {query_sql(s)} <> '' then '?' || {query_sql(s)} else '' end)"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of url_records and sightings of feed_entries in one shape."""
    index = table(spark, sf_dir, "url_records").select("urlkey", "url", F.col("last_seen_ts").alias("ts"), F.col("latest_status").alias("status"), F.col("latest_mimetype").alias("mimetype"), F.col("latest_digest").alias("digest"), F.col("latest_length").alias("length"), F.when(F.contains("source", F.lit("cdx")), "cdx").otherwise("sitemap").alias("origin"), "seq")
    none = F.lit(None).cast("string")
    feed = table(spark, sf_dir, "feed_entries").filter("url is not null").select(surt_key(F.col("url")).alias("urlkey"), "url", F.col("source_feed_timestamp").alias("ts"), none.alias("status"), none.alias("mimetype"), none.alias("digest"), none.alias("length"), F.lit("sitemap").alias("origin"), (F.col("seq") + 1_000_000_000_000).alias("seq"))
    return index.unionByName(feed)


def a1_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_index(observations(spark, sf_dir))


def a2_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolled_up(table(spark, sf_dir, "url_records"), "seq")


def a3_project_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_address(table(spark, sf_dir, "url_records"), "seq")


def a4_kept_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "url_records")
    return rows.filter(qualifies()).groupBy("kind").agg(F.count("*").alias("n"))


def a5_duplicate_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "url_records"), "latest_digest", "seq")


def a5_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "url_records"), "canonical_key", "seq")


def a6_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "url_records")
    html = (F.col("latest_status") == "200") & (F.col("latest_mimetype") == "text/html")
    return rows.agg(
        F.count("*").alias("total"),
        F.count_distinct("canonical_key").alias("canonical_keys"),
        F.count_if(html).alias("html"),
        F.count_distinct(F.when(html, F.col("canonical_key"))).alias("html_keys"),
        F.count_distinct(F.when(~F.coalesce(F.col("latest_digest"), F.lit("")).isin("", "-", "0"), F.col("latest_digest"))).alias("digests"),
    )


def a6_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("(unknown)"))
    rows = table(spark, sf_dir, "url_records").select(known(F.col("host")).alias("host"), known(F.col("kind")).alias("kind"), known(F.left("first_seen_ts", F.lit(4))).alias("year"), known(F.col("latest_status")).alias("status"), known(F.col("latest_mimetype")).alias("mimetype"), known(F.col("source")).alias("source"))
    names = ["host", "kind", "year", "status", "mimetype", "source"]
    sets = rows.groupingSets([[F.col(c)] for c in names], *names).agg(F.count("*").alias("n"))
    return sets.select(F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in names]).alias("dimension"), F.coalesce(*names).alias("value"), "n")


def a7_top_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_counts(table(spark, sf_dir, "url_records"), "host", "seq", 3)


def a8_best_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "enriched")
    score = sum((filled(c, dash=False).isNotNull().cast("int") for c in ("title", "byline", "published_at")), start=F.lit(0))
    best = first_rows(rows, ["rollup_key"], [score.desc(), F.contains("url", F.lit("/features/")).cast("int").desc_nulls_last(), F.asc("seq")])
    return best.select("rollup_key", "seq")


def a9_richest_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "feed_entries").filter("url is not null").withColumn("post", post_key(F.col("url")))
    score = sum((filled(c, dash=False).isNotNull().cast("int") for c in ("title", "byline", "published_at")), start=F.lit(0))
    return first_rows(rows, ["post"], [score.desc(), F.asc("seq")]).select("post", "seq", "source_feed_url", "source_feed_timestamp")


def a10_latest_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "url_records").filter("last_seen_ts <> '' and (coalesce(latest_status, '') in ('', '-') or latest_status like '2__')")
    best = F.max_by(F.struct("seq", "url"), F.struct("last_seen_ts", -F.col("seq")))
    return rows.groupBy("canonical_key").agg(best.alias("b"), F.max("last_seen_ts").alias("last_seen_ts")).select("canonical_key", "b.seq", "b.url", "last_seen_ts")


def a18_common_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return most_frequent(table(spark, sf_dir, "url_records"), "kind", "latest_mimetype", "seq")


def w2_spaced_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "feed_entries")
    return spaced_days(rows, "source_feed_url", F.try_to_date(F.left("source_feed_timestamp", F.lit(8)), "yyyyMMdd"), 30)


_INDEX = f"""with o as (select urlkey, url, last_seen_ts as ts, latest_status as status, latest_mimetype as mimetype, latest_digest as digest, latest_length as length,
        case when source like '%cdx%' then 'cdx' else 'sitemap' end as origin, seq from url_records
    union all select {surt_sql('url')}, url, source_feed_timestamp, null, null, null, null, 'sitemap', seq + 1000000000000 from feed_entries where url is not null),
    k as (select *, row_number() over (partition by urlkey order by nullif(ts, '') desc nulls last, seq) as late, row_number() over (partition by urlkey order by case when coalesce(url, '') <> '' then 0 else 1 end, seq) as early from o where coalesce(urlkey, '') <> '')
    select urlkey, max(case when early = 1 and url <> '' then url end) as url, min(nullif(ts, '')) as first_seen_ts, max(nullif(ts, '')) as last_seen_ts,
    {', '.join(f"max(case when late = 1 and ts <> '' then coalesce({c}, '') end) as latest_{c}" for c in ('status', 'mimetype', 'digest', 'length'))},
    count(*) filter (origin = 'cdx') as observations, array_to_string(list_sort(list_distinct(list(origin))), '+') as source from k group by urlkey"""
_QUALIFIES = """(coalesce(latest_status, '') = '200' and coalesce(latest_mimetype, '') = 'text/html' or coalesce(latest_status, '') = '' and coalesce(latest_mimetype, '') = '' and kind in ('article', 'podcast') and (source like '%sitemap%' or source like '%feed%'))"""
_DUPLICATES = """with r as (select {k}, url, host, seq, row_number() over (partition by {k} order by seq) as nth from url_records where coalesce({k}, '') not in ('', '-', '0'))
    select {k}, count(*) as url_count, count(distinct host) as host_count, array_to_string(list(coalesce(url, '') order by seq) filter (nth <= 5), ' ') as sample_urls from r group by {k} having count(*) > 1"""
_SCORE = "(case when trim(title) <> '' then 1 else 0 end + case when trim(byline) <> '' then 1 else 0 end + case when trim(published_at) <> '' then 1 else 0 end)"
_HTML = "latest_status = '200' and latest_mimetype = 'text/html'"
_PROJECTS = f"""u as (select rollup_key, url, min(seq) as place, first(canonical_key order by seq) as canonical_key, first(host order by seq) as host, first(path order by seq) as path from url_records where kind = 'project' and coalesce(url, '') <> '' and {_QUALIFIES} group by 1, 2),
        l as (select rollup_key, list({{'url': url, 'canonical_key': canonical_key, 'host': host, 'path': path}} order by place, url) as rows from u group by 1),
        k as (select rollup_key, list_reduce(rows, lambda a, b: case when len(string_split(b.url, '/')) < len(string_split(a.url, '/')) or (len(string_split(b.url, '/')) = len(string_split(a.url, '/')) and length(b.url) < length(a.url)) or (ends_with(b.url, '/') and not ends_with(a.url, '/')) then b else a end) as won from l),
        projects as (select rollup_key, won.url as url, won.canonical_key as canonical_key, won.host as host, won.path as path from k)"""
SQL = {
    "a1_index": _INDEX,
    "a2_pages": f"""with q as (select *, len(string_split(url, '/')) as slashes from url_records where kind in ('article', 'liveblog', 'podcast', 'video', 'methodology', 'project') and {_QUALIFIES}),
        r as (select *, row_number() over (partition by rollup_key order by coalesce(url, '') = '', slashes, length(url), seq) as short, row_number() over (partition by rollup_key order by coalesce(last_seen_ts, '') desc, seq) as late,
        row_number() over (partition by rollup_key order by seq) as early from q), {_PROJECTS},
        g as (select rollup_key, max(case when early = 1 then kind end) as kind, {", ".join(f"max(case when short = 1 then {c} end) as {c}" for c in ("url", "canonical_key", "host", "path"))}, min(nullif(first_seen_ts, '')) as first_seen_ts, max(nullif(last_seen_ts, '')) as last_seen_ts, count(*) as member_url_count,
        max(case when late = 1 then latest_status end) as latest_status, max(case when late = 1 then latest_mimetype end) as latest_mimetype from r group by rollup_key)
        select g.rollup_key, kind, {", ".join(f"case when kind = 'project' and p.url is not null then p.{c} else g.{c} end as {c}" for c in ("url", "canonical_key", "host", "path"))}, first_seen_ts, last_seen_ts, member_url_count, latest_status, latest_mimetype
        from g left join projects p on p.rollup_key = g.rollup_key""",
    "a3_project_address": f"with {_PROJECTS} select * from projects",
    "a4_kept_by_kind": f"select kind, count(*) as n from url_records where {_QUALIFIES} group by kind",
    "a5_duplicate_digests": _DUPLICATES.format(k="latest_digest"),
    "a5_duplicate_keys": _DUPLICATES.format(k="canonical_key"),
    "a6_summary": f"""select count(*) as total, count(distinct canonical_key) as canonical_keys, count(*) filter ({_HTML}) as html, count(distinct canonical_key) filter ({_HTML}) as html_keys,
        count(distinct latest_digest) filter (latest_digest not in ('', '-', '0')) as digests from url_records""",
    "a6_dimensions": " union all ".join(f"select '{n}' as dimension, coalesce(nullif({c}, ''), '(unknown)') as value, count(*) as n from url_records group by 2" for n, c in (("host", "host"), ("kind", "kind"), ("year", "left(first_seen_ts, 4)"), ("status", "latest_status"), ("mimetype", "latest_mimetype"), ("source", "source"))),
    "a7_top_hosts": "select coalesce(nullif(host, ''), '(unknown)') as host, count(*) as n from url_records group by 1 order by 2 desc, min(seq) limit 3",
    "a8_best_enriched": f"select rollup_key, seq from (select *, row_number() over (partition by rollup_key order by {_SCORE} desc, case when url like '%/features/%' then 1 when url is null then -1 else 0 end desc, seq) as nth from enriched) where nth = 1",
    "a9_richest_delivery": f"select post, seq, source_feed_url, source_feed_timestamp from (select *, {_POST} as post, row_number() over (partition by {_POST} order by {_SCORE} desc, seq) as nth from feed_entries where url is not null) where nth = 1",
    "a10_latest_capture": "select canonical_key, seq, url, last_seen_ts from (select *, row_number() over (partition by canonical_key order by last_seen_ts desc, seq) as nth from url_records where last_seen_ts <> '' and (coalesce(latest_status, '') in ('', '-') or latest_status like '2__')) where nth = 1",
    "a18_common_type": "select kind, latest_mimetype, n from (select kind, latest_mimetype, count(*) as n, row_number() over (partition by kind order by count(*) desc, min(seq)) as nth from url_records where coalesce(latest_mimetype, '') <> '' group by 1, 2) where nth = 1",
    "w2_spaced_snapshots": """with recursive d as (select distinct source_feed_url, try_strptime(left(source_feed_timestamp, 8), '%Y%m%d')::date as day from feed_entries where try_strptime(left(source_feed_timestamp, 8), '%Y%m%d') is not null),
        k as (select source_feed_url, min(day) as day from d group by 1 union all select k.source_feed_url, (select min(d.day) from d where d.source_feed_url is not distinct from k.source_feed_url and d.day >= k.day + 30) from k where k.day is not null)
        select source_feed_url, day from k where day is not null""",
}
QUERIES = {n: globals()[n] for n in ("a1_index", "a2_pages", "a3_project_address", "a4_kept_by_kind", "a5_duplicate_digests", "a5_duplicate_keys", "a6_summary", "a6_dimensions", "a7_top_hosts", "a8_best_enriched", "a9_richest_delivery", "a10_latest_capture", "a18_common_type", "w2_spaced_snapshots")}
