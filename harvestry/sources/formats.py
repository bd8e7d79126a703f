"""Parsers of the formats that harvests land in: capture pages, sitemaps, feeds, time maps, state and HTML pages.

JSON and regular text are parsed by built-in functions, sitemaps by built-in XPath. Feeds and HTML, which are often not
well formed, go through small parsers in Arrow batches.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPTURE = ["urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "length"]


def capture_rows(pages: DataFrame, text: str) -> DataFrame:
    """The captures of JSON pages (arrays of arrays): header rows and the trailing resume key left out, short rows padded."""
    cells = F.from_json(F.regexp_extract(F.col(text), r"(?s)^\s*(\[.*\])", 1), "array<array<string>>")
    kept = [c for c in pages.columns if c != text]
    rows = pages.select(*kept, F.posexplode(cells).alias("at", "cells")).filter((F.size("cells") > 1) & (F.col("cells")[0] != "urlkey"))
    return rows.select(*kept, "at", *[F.coalesce(F.get("cells", F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(CAPTURE)])


def resume_key(text: Column) -> Column:
    """The key that the next page begins at: a last array of one cell, or a line of plain text after the arrays; else ''."""
    last = F.try_element_at(F.from_json(F.regexp_extract(text, r"(?s)^\s*(\[.*\])", 1), "array<array<string>>"), F.lit(-1))
    plain = F.trim(F.regexp_extract(text, r"(?s)\]\s*\n\s*\n([^\[\]]+)$", 1))
    return F.when(F.size(last) == 1, last[0]).otherwise(plain)


def sitemap_urls(sitemaps: DataFrame, xml: str) -> DataFrame:
    """(…, loc): the addresses of sitemaps and sitemap indexes, whatever their namespace; broken XML has none."""
    kept = [c for c in sitemaps.columns if c != xml]
    read = F.from_xml(F.col(xml), "url array<struct<loc:string>>, sitemap array<struct<loc:string>>", {"ignoreNamespace": "true", "mode": "PERMISSIVE"})
    entries = F.concat(*[F.coalesce(read[c]["loc"], F.array().cast("array<string>")) for c in ("url", "sitemap")])
    return sitemaps.select(*kept, F.explode(entries).alias("loc")).withColumn("loc", F.trim("loc")).filter("loc <> ''")


def memento_times(maps: DataFrame, text: str) -> DataFrame:
    """(…, ts): the timestamps of the mementos of link-format time maps."""
    kept = [c for c in maps.columns if c != text]
    lines = maps.select(*kept, F.explode(F.split(F.col(text), r"\r?\n")).alias("line")).filter(F.col("line").rlike(r'rel="[^"]*\bmemento\b'))
    return lines.select(*kept, F.regexp_extract("line", r"/(\d{14})(?:[a-z]{2}_)?/", 1).alias("ts")).filter("ts <> ''")


def state_records(states: DataFrame, text: str) -> DataFrame:
    """(…, shard_id, done, resume_key, rows) of crawl states {"shards": {id: {…}}}."""
    kept = [c for c in states.columns if c != text]
    shards = F.from_json(F.col(text), "struct<shards:map<string,struct<done:boolean,resume_key:string,rows:bigint>>>")["shards"]
    return states.select(*kept, F.explode(shards).alias("shard_id", "s")).select(*kept, "shard_id", "s.done", "s.resume_key", "s.rows")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2].lower()


def feed_items(body: str | None) -> list[tuple[str, str, str, str]]:
    """(url, title, byline, published) of RSS or Atom items; none of a body that can't be parsed."""
    try:
        root = ET.fromstring(body or "")
    except ET.ParseError:
        return []
    out = []
    for item in root.iter():
        if _local(item.tag) not in ("item", "entry"):
            continue
        found: dict[str, str] = {}
        for child in item:
            name, text = _local(child.tag), (child.text or "").strip()
            if name == "link":
                text = text or child.get("href", "")
            elif name == "enclosure":
                text = child.get("url", "")
            elif name == "author" and not text:
                text = next(((x.text or "").strip() for x in child if _local(x.tag) == "name"), "")
            found.setdefault(name, text)
        first = lambda *names: next((found[n] for n in names if found.get(n)), "")  # noqa: E731,B023
        out.append((first("link", "guid", "id", "enclosure"), first("title"), first("creator", "author"), first("pubdate", "published", "updated", "date")))
    return out


_ITEM = "array<struct<url:string,title:string,byline:string,published_at:string>>"


def feed_rows(feeds: DataFrame, xml: str) -> DataFrame:
    """(…, at, url, title, byline, published_at): the items of feeds in order."""

    @F.pandas_udf(_ITEM)
    def items(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("url", "title", "byline", "published_at")
        for batch in batches:
            yield batch.map(lambda body: [dict(zip(names, x, strict=True)) for x in feed_items(body)])

    kept = [c for c in feeds.columns if c != xml]
    return feeds.select(*kept, F.posexplode(items(F.col(xml))).alias("at", "item")).select(*kept, "at", "item.*")


class _Page(HTMLParser):
    """What a page says about itself: metas, JSON-LD, title, headings, times and pictures."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.ld: list[str] = []
        self.text: dict[str, str] = {}
        self.time, self.images, self.links = "", [], []
        self._open: list[str] = []
        self._ld = False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta" and (name := a.get("property") or a.get("name") or a.get("itemprop")):
            self.meta.setdefault(name.lower(), a.get("content", ""))
        elif tag == "script":
            self._ld = "ld+json" in a.get("type", "")
            if self._ld:
                self.ld.append("")
        elif tag == "time":
            self.time = self.time or a.get("datetime", "")
        elif tag in ("img", "source"):
            sets = [x.strip().split() for x in a.get("srcset", "").split(",") if x.strip()]
            wide = sorted(((int(re.sub(r"\D", "", x[1]) or 0) if len(x) > 1 else 0, x[0]) for x in sets), reverse=True)
            self.images += [u for u in [a.get("src", ""), *(u for _, u in wide)] if u]
        elif tag == "a" and a.get("rel") == "author":
            self._open.append("author")
            return
        elif tag == "a" and a.get("href"):
            self.links.append(a["href"])
        if tag in ("title", "h1"):
            self._open.append(tag)

    def handle_endtag(self, tag):
        if tag == "script":
            self._ld = False
        if self._open and (tag == self._open[-1] or tag == "a" and self._open[-1] == "author"):
            self._open.pop()

    def handle_data(self, data):
        if self._ld:
            self.ld[-1] += data
        elif self._open:
            self.text[self._open[-1]] = self.text.get(self._open[-1], "") + data


def _objects(blocks: list[str]) -> list[dict]:
    """The objects of JSON-LD blocks, lists and graphs laid flat, broken blocks skipped."""
    out, todo = [], []
    for block in blocks:
        try:
            todo.append(json.loads(block))
        except ValueError:
            continue
    while todo:
        x = todo.pop(0)
        if isinstance(x, list):
            todo = x + todo
        elif isinstance(x, dict):
            out.append(x)
            todo = (x["@graph"] if isinstance(x.get("@graph"), list) else []) + todo
    return out


def _names(author) -> list[str]:
    if isinstance(author, str):
        return [author.strip()] if author.strip() else []
    if isinstance(author, dict):
        return _names(author.get("name") or "")
    return [n for a in author for n in _names(a)] if isinstance(author, list) else []


def page_facts(html: str | None) -> dict:
    """Title, byline, time of publication, where they were found, and the pictures of a page, by falling back from the most
    to the least reliable statement; '' and none for a page without any."""
    page = _Page()
    page.feed(html or "")
    ld = _objects(page.ld)
    clean = lambda s: " ".join((s or "").split())

    def pick(options):
        return next(((clean(v), how) for how, v in options if clean(v)), ("", ""))

    title, t = pick([("og", page.meta.get("og:title")), ("twitter", page.meta.get("twitter:title")), *(("jsonld", o.get("headline") or o.get("name")) for o in ld if isinstance(o.get("headline") or o.get("name"), str)), ("title", page.text.get("title")), ("h1", page.text.get("h1"))])
    byline, _ = pick([*(("jsonld", ", ".join(_names(o.get("author")))) for o in ld), *((m, page.meta.get(m)) for m in ("author", "article:author", "parsely-author")), ("rel", page.text.get("author"))])
    published, p = pick([("meta", page.meta.get("article:published_time")), *(("jsonld", o.get("datePublished")) for o in ld if isinstance(o.get("datePublished"), str)), ("meta", page.meta.get("date")), ("time", page.time)])
    return {"title": title, "byline": byline, "published_at": published, "via": "+".join(dict.fromkeys(x for x in (t, p) if x)), "images": list(dict.fromkeys(page.images))}


def extracted(pages: DataFrame, html: str) -> DataFrame:
    """(…, title, byline, published_at, via, images) of HTML pages."""

    @F.pandas_udf("struct<title:string,byline:string,published_at:string,via:string,images:array<string>>")
    def facts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([page_facts(x) for x in batch], columns=["title", "byline", "published_at", "via", "images"])

    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, facts(F.col(html)).alias("facts")).select(*kept, "facts.*")


def audio_urls(text: Column) -> Column:
    """The distinct audio addresses in a text as it stands, with entities decoded, and with percent escapes decoded."""
    form = F.lit(r"""https?://[^\s"'<>\\]+?\.mp3""")
    plain = F.replace(F.replace(text, F.lit("&amp;"), F.lit("&")), F.lit("&#x2F;"), F.lit("/"))
    decoded = F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain)
    return F.array_union(F.array_union(F.regexp_extract_all(text, form, 0), F.regexp_extract_all(plain, form, 0)), F.regexp_extract_all(decoded, form, 0))


def first_json_map(text: Column) -> Column:
    """The first {…} of a text as a map of texts; null where it isn't one."""
    return F.from_json(F.regexp_extract(text, r"(?s)(\{.*\})", 1), "map<string,string>")
