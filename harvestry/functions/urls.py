"""Columns made from addresses. Addresses are cut by the generic syntax of RFC 3986, so odd ones are cut too, never refused."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import computed
from .text import strip_blank

_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
#: Names of parameters that only track a visit, matched whole and without regard to case.
TRACKING = r"utm_.*|fbclid|gclid|msclkid|mc_cid|mc_eid|_ga|igshid|at_.*|__twitter_impression|ref|ref_src|ref_url|xid|cmpid"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, _PARTS, n)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 1))


def host(url: Column) -> Column:
    """Lower case, without user, port and brackets; '' where there is none."""
    return F.lower(F.regexp_replace(F.regexp_replace(part(url, 2), r"^.*@", ""), r":\d*$", ""))


def bare_host(url: Column) -> Column:
    """The host without one leading `www.`"""
    return F.regexp_replace(host(url), r"^www\.", "")


def path(url: Column) -> Column:
    return part(url, 3)


def query(url: Column) -> Column:
    return part(url, 4)


def percent_decoded(text: Column, plus: bool) -> Column:
    """Percent escapes decoded, malformed ones left as they are; `+` means a space only where `plus` says so."""
    safe = text if plus else F.replace(text, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(safe), text)


def kept_query(raw: Column) -> Column:
    """The parameters without tracking ones, decoded and sorted by name and value; a blank value leaves the name alone."""
    pairs = F.filter(F.split(raw, "&"), lambda p: p != "")
    cut = F.transform(pairs, lambda p: F.struct(percent_decoded(F.substring_index(p, "=", 1), True).alias("k"), percent_decoded(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, r"^[^=]*=", "")).otherwise(""), True).alias("v")))
    kept = F.array_sort(F.filter(cut, lambda x: ~x["k"].rlike(f"(?i)^(?:{TRACKING})$")))
    return F.array_join(F.transform(kept, lambda x: F.when(x["v"] != "", F.concat(x["k"], F.lit("="), x["v"])).otherwise(x["k"])), "&")


def trimmed_path(url: Column) -> Column:
    """Without trailing slashes; `/` for the root and for none."""
    cut = F.regexp_replace(path(url), "/+$", "")
    return F.when(cut == "", "/").otherwise(cut)


def canonical_key(url: Column) -> Column:
    """What the spellings of one page's address share: host and path with the kept parameters; '' for a blank address."""
    kept = lambda clean: F.concat(F.lit("?"), F.nullif(kept_query(query(clean)), F.lit("")))
    key = lambda clean: F.concat(bare_host(clean), trimmed_path(clean), F.coalesce(kept(clean), F.lit("")))
    return let(strip_blank(url), lambda clean: F.when(clean == "", "").otherwise(key(clean)))


def canonical_url(url: Column) -> Column:
    return F.when(strip_blank(url) == "", "").otherwise(F.concat(F.lit("//"), canonical_key(url)))


def surt_key(url: Column) -> Column:
    """Host labels in reverse, then path without leading slashes and the raw query, all in lower case; `www.` stays."""
    def key(clean: Column) -> Column:
        labels = F.array_join(F.reverse(F.split(host(clean), r"\.")), ",")
        raw = F.concat(F.lit("?"), F.nullif(query(clean), F.lit("")))
        return F.lower(F.concat(labels, F.lit(")/"), F.regexp_replace(path(clean), "^/+", ""), F.coalesce(raw, F.lit(""))))

    return let(strip_blank(url), key)


def article_key(url: Column) -> Column:
    return F.concat(host(url), F.regexp_replace(path(url), "/+$", ""))


def same_target(a: Column, b: Column) -> Column:
    return article_key(a) == article_key(b)


def image_key(url: Column) -> Column:
    """For finding images again: always https, no `www.`, ports other than 80 and 443 kept, no query."""
    port = F.regexp_extract(part(url, 2), r":(\d+)$", 1)
    shown = F.when((port != "") & ~port.isin("80", "443"), F.concat(F.lit(":"), port)).otherwise("")
    return F.when(url == "", "").otherwise(F.concat(F.lit("https://"), bare_host(url), shown, path(url)))


def audio_url(url: Column) -> Column:
    """With https where no scheme is given, `.mp` completed to `.mp3`, without query."""
    full = F.when(url.rlike(r"^[a-z]+://"), url).otherwise(F.concat(F.lit("https://"), F.regexp_replace(url, "^//", "")))
    return F.regexp_replace(F.substring_index(F.substring_index(full, "#", 1), "?", 1), r"\.mp$", ".mp3")


def without_first_utm(url: Column) -> Column:
    """Without the query where its first parameter is a utm one."""
    return F.regexp_replace(url, r"\?utm_.*$", "")


def file_name(url: Column) -> Column:
    return F.concat(F.replace(host(url), F.lit("."), F.lit("_")), F.lit("__"), F.regexp_extract(path(url), r"([^/]*)$", 1))


def archive_url(ts: Column, url: Column, root: str) -> Column:
    return F.when((F.coalesce(ts, F.lit("")) == "") | (F.coalesce(url, F.lit("")) == ""), "").otherwise(F.concat(F.lit(root), ts, F.lit("/"), url))


def archive_timestamp(url: Column) -> Column:
    return F.regexp_extract(url, r"/web/(\d{8,14})", 1)


def year_in_path(url: Column) -> Column:
    """The latest year from 2008 to 2029 that stands alone in the path; null if none does."""
    years = F.transform(F.regexp_extract_all(path(url), F.lit(r"(?<!\d)(20[0-2]\d)(?!\d)"), 1), lambda y: y.cast("int"))
    return F.array_max(F.filter(years, lambda y: y.between(2008, 2029)))


def slug(segment: Column) -> Column:
    """A path segment decoded, without invisible marks, runs of `-` and blanks made one `-`, none at the ends."""
    text = F.regexp_replace(percent_decoded(segment, False), "[​‎]", "")
    return F.regexp_replace(F.regexp_replace(text, r"[-\s]+", "-"), "^-+|-+$", "")


@dataclass(frozen=True)
class Rule:
    """A kind of page: where its addresses lie, and what names the page in them (the groups of `path`, joined by /)."""

    kind: str
    host: str
    path: str
    prefix: str


#: The rules of the harvested site, in order; hosts are matched without `www.`, paths without doubled slashes.
SITE_RULES = (
    Rule("article", r"tallyboard\.example", r"^/(\d{4})/(\d{2})/([^/]+)\.html?/?$", "article:wp/"),
    Rule("project", r"projects\.tallyboard\.example", r"^/(.+?)/*$", "project:"),
    Rule("article", r"tallyboard\.example", r"^/(?:features|datalab)/([^/]+)/?$", "article:"),
    Rule("liveblog", r"tallyboard\.example", r"^/live-?blogs?/([^/]+)(?:/.*)?$", "liveblog:"),
    Rule("podcast", r"tallyboard\.example", r"^/podcasts?/([^/]+)/?$", "podcast:"),
    Rule("video", r"tallyboard\.example", r"^/videos/([^/]+)/?$", "video:"),
    Rule("methodology", r"tallyboard\.example", r"^/methodology/([^/]+)(?:/.*)?$", "methodology:"),
    Rule("tag", r"tallyboard\.example", r"^(/tag/.*)$", "tag:"),
    Rule("homepage", r"tallyboard\.example", r"^()/?$", "site:/"),
)


def classified(df: DataFrame, url: Column, name: str, rules: tuple[Rule, ...] = SITE_RULES) -> DataFrame:
    """`df` with `name`: struct(kind, rollup_key) by the first rule that fits `url`; `other` and the path where none does.

    Host and path are cut once a row, then the rule is chosen, and only what that rule names is taken out of the path.
    Other columns stay; their names must not begin with `c_`.
    """
    rows = computed(df, {"c_host": bare_host(url), "c_path": F.regexp_replace(path(url), "/{2,}", "/")})
    host_of, path_of = F.col("c_host"), F.col("c_path")
    rows = computed(rows, {"c_rule": F.coalesce(*[F.when(host_of.rlike(f"^{r.host}$") & path_of.rlike(r.path), F.lit(k)) for k, r in enumerate(rules)], F.lit(-1))})
    pieces, kind, prefix = F.array(path_of), F.lit("other"), F.lit("other:")
    for k, rule in enumerate(rules):
        chosen, groups = F.col("c_rule") == k, rule.path.count("(") - rule.path.count("(?")
        pieces = F.when(chosen, F.array(*[F.regexp_extract(path_of, rule.path, g) for g in range(1, groups + 1)])).otherwise(pieces)
        kind, prefix = F.when(chosen, F.lit(rule.kind)).otherwise(kind), F.when(chosen, F.lit(rule.prefix)).otherwise(prefix)
    rows = computed(rows, {"c_pieces": pieces, "c_kind": kind, "c_prefix": prefix})
    named = F.transform("c_pieces", lambda x: F.array_join(F.transform(F.split(x, "/"), slug), "/"))
    named = F.when(F.col("c_kind").isin("tag", "other"), F.col("c_pieces")).otherwise(named)
    key = F.concat(F.col("c_prefix"), F.concat_ws("/", named))
    return rows.select(*df.columns, F.struct(F.col("c_kind").alias("kind"), F.when(path_of.isNotNull(), key).alias("rollup_key")).alias(name))
