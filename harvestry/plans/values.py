"""Queries that apply the column functions to whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, titles, urls
from ..functions.text import strip_blank
from ..session import computed, table
from .index import PARTS, host_sql, path_sql, query_sql, strip_sql, surt_sql

ROOT = "https://archive.example/web/"


def _columns(spark: SparkSession, sf_dir: str, name: str, key: str, columns: dict[str, Column]) -> DataFrame:
    return computed(table(spark, sf_dir, name), columns).select(key, *columns)


def u1_canonical_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "url_records", "seq", {"k": urls.canonical_key(F.coalesce("url", F.lit("")))})


def u4_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _columns(spark, sf_dir, "url_records", "seq", {"url_scheme": urls.scheme(u), "url_host": urls.host(u), "url_path": urls.path(u), "url_query": urls.query(u)})


def u7_surt_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "url_records", "seq", {"surt": urls.surt_key(F.col("url"))})


def u9_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = urls.classified(table(spark, sf_dir, "url_records").select("seq", "url"), strip_blank(F.col("url")), "page")
    return rows.select("seq", F.col("page.kind").alias("kind"), F.col("page.rollup_key").alias("rollup_key"))


def u16_image_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "podcast_metadata", "seq", {"image_key": urls.image_key(F.col("thumbnail"))})


def u17_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "podcast_metadata", "seq", {"audio": urls.audio_url(F.col("mp3_url")), "file_name": urls.file_name(F.col("mp3_url"))})


def u20_article_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _columns(spark, sf_dir, "site_records", "seq", {"article_key": urls.article_key(u), "bare": urls.without_first_utm(u), "year_in_path": urls.year_in_path(u), "file": titles.page_file(F.col("year"), u)})


def u23_archive_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, u = F.col("snapshot_timestamp"), F.col("url")
    return _columns(spark, sf_dir, "enriched", "seq", {"link": urls.archive_url(ts, u, ROOT), "link_ts": urls.archive_timestamp(F.coalesce("wayback_url", F.lit("")))})


def u26_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return _columns(spark, sf_dir, "enriched", "seq", {"clean": titles.clean_title(t), "key": titles.title_key(t)})


def u27_display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "feed_entries", "seq", {"name": titles.display_name(F.col("byline"))})


def u29_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = computed(table(spark, sf_dir, "enriched").filter("byline is not null"), {"authors": titles.authors_of(F.col("byline"))})
    return rows.select("seq", F.array_join("authors", "; ").alias("authors"), titles.joined_names(F.col("authors")).alias("byline_clean"), F.size("authors").alias("n"))


def u32_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "site_records", "seq", {"slug": titles.slugify(F.col("byline")), "site_slug": titles.slugify(F.col("byline"), True)})


def u34_project_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "url_records").filter("kind = 'project'")
    return rows.select("seq", titles.drilldown_suffix(F.col("rollup_key")).alias("suffix"))


def u35_url_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "curated", "seq", {"url_title": titles.last_segment_title(urls.path(F.col("url")))})


def u42_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return _columns(spark, sf_dir, "podcast_metadata", "seq", {"made": titles.identifier(F.lit("tallyboard"), c("show_slug"), c("date"), c("title")), "hashed": titles.hash_key("audio-", F.coalesce("mp3_url", F.lit(""))), "show_name": titles.words_of_slug(c("show_slug"))})


def u43_title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "podcast_metadata").filter("title is not null")
    return rows.select("seq", F.explode(titles.plain_keys(F.col("title"))).alias("key"))


def d1_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("published_at")
    return _columns(spark, sf_dir, "enriched", "seq", {"iso": dates.iso_like(p), "site": dates.site_date(p), "year": dates.stated_year(p), "day": dates.day_of(p), "whole": dates.full_date(p)})


def d3_feed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "feed_entries", "seq", {"published": dates.published(F.col("published_at"))})


def d9_lag_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "url_records").filter("first_seen_ts is not null and last_seen_ts is not null")
    return rows.select("seq", dates.days_between(F.col("first_seen_ts"), F.col("last_seen_ts")).alias("days"))


_TRACK = r"^(?:utm_.*|fbclid|gclid|msclkid|mc_cid|mc_eid|_ga|igshid|at_.*|__twitter_impression|ref|ref_src|ref_url|xid|cmpid)$"
_U = strip_sql("coalesce(url, '')")
_PAIRS = f"list_filter(string_split({query_sql(_U)}, '&'), lambda p: p <> '')"
_CUT = f"list_transform({_PAIRS}, lambda p: {{'k': url_decode(replace(split_part(p, '=', 1), '+', '%20')), 'v': case when contains(p, '=') then url_decode(replace(regexp_replace(p, '^[^=]*=', ''), '+', '%20')) else '' end}})"
_KEPT = f"array_to_string(list_transform(list_sort(list_filter({_CUT}, lambda x: not regexp_full_match(x.k, '{_TRACK}', 'i'))), lambda x: case when x.v <> '' then x.k || '=' || x.v else x.k end), '&')"
_CANONICAL = f"""case when {_U} = '' then '' else regexp_replace({host_sql(_U)}, '^www\\.', '') || case when regexp_replace({path_sql(_U)}, '/+$', '') = '' then '/' else regexp_replace({path_sql(_U)}, '/+$', '') end || case when {_KEPT} <> '' then '?' || {_KEPT} else '' end end"""
_SLUG = "regexp_replace(regexp_replace({}, '[-[:space:]]+', '-', 'g'), '^-+|-+$', '', 'g')"
_EDGE = r"[|:\-–—\s]+"
_CLEAN = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g')), '^{_EDGE}|{_EDGE}$', '', 'g'), '\s*[|–—-]\s*Tallyboard$', ''), '^Tallyboard\s*[|:–—-]\s*', ''), '^{_EDGE}|{_EDGE}$', '', 'g')"
_WIDE = r"trim(regexp_replace(coalesce(byline, ''), '\s+', ' ', 'g'))"
_DISPLAY = rf"case when regexp_extract({_WIDE}, '^\S+@\S+ \(([^)]+)\)$', 1) <> '' then regexp_extract({_WIDE}, '^\S+@\S+ \(([^)]+)\)$', 1) else {_WIDE} end"
_ID = r"regexp_replace(lower(concat_ws('-', 'tallyboard', show_slug, date, title)), '[^a-z0-9]+', '-', 'g')"
_NORM = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_ISO = r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})"
_PUB = "trim(coalesce(published_at, ''), ' ' || chr(9) || chr(10) || chr(13))"
_RAW = f"regexp_replace({_PUB}, '^[\"'']+|[\"'']+$', '', 'g')"
_MAIL = r"^(?:[A-Za-z]{3},?\s+)?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}:\d{2}:\d{2}) ([+-]\d{4}|GMT)$"
_M = lambda g: f"regexp_extract({_PUB}, '{_MAIL}', {g})"
_H, _P = f"regexp_replace({host_sql(strip_sql('url'))}, '^www\\.', '')", f"regexp_replace({path_sql(strip_sql('url'))}, '/{{2,}}', '/', 'g')"


def _rule_sql(rule: urls.Rule) -> str:
    groups = rule.path.count("(") - rule.path.count("(?")
    pieces = [f"regexp_extract({_P}, '{rule.path}', {g})" for g in range(1, groups + 1)]
    if rule.kind != "tag":
        pieces = [f"array_to_string(list_transform(string_split({x}, '/'), lambda s: {_SLUG.format('url_decode(s)')}), '/')" for x in pieces]
    return f"when regexp_full_match({_H}, '{rule.host}') and regexp_matches({_P}, '{rule.path}') then {{'kind': '{rule.kind}', 'rollup_key': '{rule.prefix}' || concat_ws('/', {', '.join(pieces)})}}"


SQL = {
    "u9_classified": f"select seq, page.kind as kind, page.rollup_key as rollup_key from (select seq, case {' '.join(map(_rule_sql, urls.SITE_RULES))} else {{'kind': 'other', 'rollup_key': 'other:' || {_P}}} end as page from url_records)",
    "u1_canonical_key": f"select seq, {_CANONICAL} as k from url_records",
    "u4_url_parts": f"select seq, lower(regexp_extract(url, '{PARTS}', 1)) as url_scheme, {host_sql('url')} as url_host, {path_sql('url')} as url_path, {query_sql('url')} as url_query from url_records",
    "u7_surt_key": f"select seq, {surt_sql('url')} as surt from url_records",
    "u16_image_keys": rf"""select seq, case when thumbnail = '' then '' else 'https://' || regexp_replace({host_sql('thumbnail')}, '^www\.', '') || case when regexp_extract(regexp_extract(thumbnail, '{PARTS}', 2), ':(\d+)$', 1) not in ('', '80', '443') then ':' || regexp_extract(regexp_extract(thumbnail, '{PARTS}', 2), ':(\d+)$', 1) else '' end || {path_sql('thumbnail')} end as image_key from podcast_metadata""",
    "u17_audio": rf"""with a as (select seq, mp3_url, case when regexp_matches(mp3_url, '^[a-z]+://') then mp3_url else 'https://' || regexp_replace(mp3_url, '^//', '') end as full_url from podcast_metadata)
        select seq, regexp_replace(split_part(split_part(full_url, '#', 1), '?', 1), '\.mp$', '.mp3') as audio, replace({host_sql('mp3_url')}, '.', '_') || '__' || regexp_extract({path_sql('mp3_url')}, '([^/]*)$', 1) as file_name from a""",
    "u20_article_key": rf"""select seq, {host_sql('url')} || regexp_replace({path_sql('url')}, '/+$', '') as article_key, regexp_replace(url, '\?utm_.*$', '') as bare,
        list_max(list_filter(list_transform(list_filter(regexp_extract_all({path_sql('url')}, '\d+'), lambda y: regexp_full_match(y, '20[0-2]\d')), lambda y: y::int), lambda y: y between 2008 and 2029)) as year_in_path,
        'data/articles/' || coalesce(year::varchar, 'unknown') || case when url is null then '' else '/' || left(sha1(url), 16) || '.html.gz' end as file from site_records""",
    "u23_archive_links": rf"""select seq, case when coalesce(snapshot_timestamp, '') = '' or coalesce(url, '') = '' then '' else '{ROOT}' || snapshot_timestamp || '/' || url end as link, regexp_extract(coalesce(wayback_url, ''), '/web/(\d{{8,14}})', 1) as link_ts from enriched""",
    "u26_titles": f"select seq, case when lower({_CLEAN}) = 'tallyboard' then '' else {_CLEAN} end as clean, lower(translate(trim(coalesce(title, '')), '‘’“”–—', '''''\"\"--')) as key from enriched",
    "u27_display_names": f"select seq, {_DISPLAY} as name from feed_entries",
    "u34_project_suffix": r"select seq, array_to_string(list_transform(regexp_extract_all(lower(array_to_string(string_split(replace(regexp_extract(rollup_key, '^project:[^/]+/(.+)$', 1), '-', ' '), '/'), ' / ')), '(\p{L}+|\P{L}+)'), lambda w: upper(w[1]) || w[2:]), '') as suffix from url_records where kind = 'project'",
    "u35_url_titles": rf"""with s as (select seq, url, lower(regexp_replace(regexp_replace(regexp_extract({path_sql('url')}, '([^/]+)/*$', 1), '\.html?$', ''), '[-_]+', ' ', 'g')) as w from curated) select seq, upper(w[1]) || w[2:] as url_title from s""",
    "u42_identifiers": rf"""select seq, regexp_replace(left(regexp_replace({_ID}, '^-+|-+$', '', 'g'), 100), '-+$', '') as made, 'audio-' || left(sha1(coalesce(mp3_url, '')), 12) as hashed,
        array_to_string(list_transform(list_filter(regexp_split_to_array(lower(show_slug), '[-_]+'), lambda w: w <> ''), lambda w: case when w in ('nba', 'nfl', 'mlb', 'us', 'uk', 'gop') then upper(w) else upper(w[1]) || w[2:] end), ' ') as show_name from podcast_metadata""",
    "u43_title_keys": rf"""select seq, unnest(list_filter(list_distinct([{_NORM.format('title')}, {_NORM.format("regexp_replace(title, '^[^:]{1,40}:[[:space:]]*', '')")}]), lambda k: k <> '')) as key from podcast_metadata where title is not null""",
    "d1_dates": rf"""select seq, case when regexp_matches({_RAW}, '{_ISO}') then concat_ws('-', regexp_extract({_RAW}, '{_ISO}', 1), lpad(regexp_extract({_RAW}, '{_ISO}', 2), 2, '0'), lpad(regexp_extract({_RAW}, '{_ISO}', 3), 2, '0')) else {_RAW} end as iso,
        case when regexp_full_match({_PUB}, '\d{{8}}|\d{{14}}') then concat_ws('-', {_PUB}[1:4], {_PUB}[5:6], {_PUB}[7:8]) when regexp_full_match({_PUB}, '\d{{6}}') then concat_ws('-', {_PUB}[1:4], {_PUB}[5:6]) else {_PUB} end as site,
        case when regexp_matches(coalesce(published_at, ''), '^(?:20|19)\d\d(?:\D|$)') then published_at[1:4] else '' end as year, case when length(published_at) >= 10 then left(published_at, 10) else published_at end as day,
        case when regexp_matches(coalesce(published_at, ''), '^\d{{4}}-\d{{2}}-\d{{2}}') then published_at else '' end as whole from enriched""",
    "d3_feed_dates": f"""select seq, case when regexp_matches({_PUB}, '{_MAIL}') then {_M(3)} || '-' || lpad(((instr('JanFebMarAprMayJunJulAugSepOctNovDec', {_M(2)}) + 2) // 3)::varchar, 2, '0') || '-' || lpad({_M(1)}, 2, '0') || 'T' || {_M(4)}
        || case when {_M(5)} = 'GMT' then '' else {_M(5)}[1:3] || ':' || {_M(5)}[4:5] end else {_PUB} end as published from feed_entries""",
    "d9_lag_days": "select seq, date_diff('day', try_strptime(left(first_seen_ts, 8), '%Y%m%d')::date, try_strptime(left(last_seen_ts, 8), '%Y%m%d')::date)::int as days from url_records where first_seen_ts is not null and last_seen_ts is not null",
}
QUERIES = {n: f for n, f in globals().items() if n[:1] in "ud" and n[1:2].isdigit() and callable(f)}
