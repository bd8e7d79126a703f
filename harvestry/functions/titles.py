"""Columns made from titles, names and slugs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The site's names and how it adds them to titles.
SITE = "Tallyboard"
_EDGE = r"[|:\-–—\s]+"


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def clean_title(raw: Column, site: str = SITE) -> Column:
    """Blanks collapsed, marks at the edges and the site's name gone; '' where only the site's name is left."""
    s = F.regexp_replace(collapsed(raw), f"^{_EDGE}|{_EDGE}$", "")
    s = F.regexp_replace(s, rf"\s*[|–—-]\s*{site}$", "")
    s = F.regexp_replace(s, rf"^{site}\s*[|:–—-]\s*", "")
    s = F.regexp_replace(s, f"^{_EDGE}|{_EDGE}$", "")
    return F.when(F.lower(s) == site.lower(), "").otherwise(s)


def display_name(text: Column) -> Column:
    """Of `mail@host (Name)` the name, else the text with blanks collapsed."""
    s = collapsed(text)
    inner = F.regexp_extract(s, r"^\S+@\S+ \(([^)]+)\)$", 1)
    return F.when(inner != "", inner).otherwise(s)


def joined_names(names: Column) -> Column:
    """`A`, `A and B`, `A, B, and C`; '' for none."""
    n = F.size(names)
    many = F.concat(F.array_join(F.slice(names, F.lit(1), F.greatest(n - 1, F.lit(1))), ", "), F.lit(", and "), F.try_element_at(names, n))
    return F.when(n <= 1, F.array_join(names, "")).when(n == 2, F.array_join(names, " and ")).otherwise(many)


def title_cased(text: Column) -> Column:
    """Every letter after a non-letter capital, the others small."""
    letters = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(letters, lambda w: F.concat(F.upper(w.substr(1, 1)), w.substr(F.lit(2), F.length(w)))), "")


#: Roles and dashes in front of a credit, and what stands between credits.
ROLE = r"(?i)^(?:[-–—]+\s*|(?:edited by|written by|posted by|by)\s+)"
BETWEEN = r"(?i)\s*(?:,\s*and\s+|,\s*|\s+and\s+|\s*/\s*|\s*\|\s*)\s*"
#: Credits that name nobody, and what such credits begin with.
NO_PERSONS = ("staff", "staff reports", "newsroom", "admin", "tallyboard", "tallyboard video", "a tallyboard chat", "abc news", "espn", "the new york times")
NO_PERSON_STARTS = ("published ", "updated ", "art by ", "design by ", "illustration by ", "illustrations by ", "photos by ", "photography by ", "video by ")


def distinct_in_order(names: Column) -> Column:
    """Without later repeats, letter case aside; the first spelling stays."""
    return F.aggregate(names, F.array().cast("array<string>"), lambda kept, x: F.when(F.exists(kept, lambda k: F.lower(k) == F.lower(x)), kept).otherwise(F.concat(kept, F.array(x))))


def authors_of(byline: Column) -> Column:
    """The persons of a byline in order: mail form unwrapped, one role in front dropped, split at commas, slashes, bars and
    `and`, shouted names calmed, credits of nobody and anything with digits left out."""
    s = F.regexp_replace(display_name(byline), ROLE, "")
    parts = F.transform(F.split(s, BETWEEN), lambda p: F.regexp_replace(F.trim(p), r"^[.,;\s]+|[.,;\s]+$", ""))
    calm = F.transform(parts, lambda p: F.when((p == F.upper(p)) & F.contains(p, F.lit(" ")), title_cased(p)).otherwise(p))
    real = F.filter(calm, lambda p: (p != "") & ~p.rlike(r"\d") & ~F.lower(p).isin(*NO_PERSONS) & ~F.lower(p).rlike("^(?:" + "|".join(NO_PERSON_STARTS) + ")"))
    return distinct_in_order(real)


def title_key(title: Column) -> Column:
    """For finding a title again: trimmed, curly quotes and dashes made plain, small letters."""
    return F.lower(F.translate(F.trim(F.coalesce(title, F.lit(""))), "‘’“”–—", "''\"\"--"))


def last_segment_title(url_path: Column) -> Column:
    """A title made from the last segment of a path, without its ending."""
    segment = F.regexp_replace(F.regexp_extract(url_path, r"([^/]+)/*$", 1), r"\.html?$", "")
    words = F.lower(F.regexp_replace(segment, r"[-_]+", " "))
    return F.concat(F.upper(words.substr(1, 1)), words.substr(F.lit(2), F.length(words)))


def drilldown_suffix(rollup_key: Column) -> Column:
    """What follows the first segment of a project's key, as words; '' where nothing does."""
    rest = F.regexp_extract(rollup_key, r"^project:[^/]+/(.+)$", 1)
    return title_cased(F.array_join(F.split(F.regexp_replace(rest, "-", " "), "/"), " / "))


def words_of_slug(slug: Column, acronyms: tuple[str, ...] = ("nba", "nfl", "mlb", "us", "uk", "gop")) -> Column:
    parts = F.filter(F.split(F.lower(slug), "[-_]+"), lambda w: w != "")
    return F.array_join(F.transform(parts, lambda w: F.when(w.isin(*acronyms), F.upper(w)).otherwise(F.concat(F.upper(w.substr(1, 1)), w.substr(F.lit(2), F.length(w))))), " ")


def identifier(*parts: Column) -> Column:
    """Parts joined as one slug of at most 100 characters."""
    text = F.regexp_replace(F.lower(F.concat_ws("-", *parts)), r"[^a-z0-9]+", "-")
    return F.regexp_replace(F.left(F.regexp_replace(text, "^-+|-+$", ""), F.lit(100)), "-+$", "")


def plain_keys(title: Column) -> Column:
    """Keys under which a title may be known: its letters and digits, and those after a leading `Name:`."""
    norm = lambda t: F.trim(F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}]+", " "))
    after = F.regexp_replace(title, r"^[^:]{1,40}:\s*", "")
    return F.filter(F.array_distinct(F.array(norm(title), norm(after))), lambda k: k != "")


def hash_key(prefix: str, text: Column, size: int = 12) -> Column:
    return F.concat(F.lit(prefix), F.left(F.sha1(text), F.lit(size)))


def page_file(year: Column, url: Column, root: str = "data/articles") -> Column:
    return F.concat_ws("/", F.lit(root), F.coalesce(year.cast("string"), F.lit("unknown")), F.concat(F.left(F.sha1(url), F.lit(16)), F.lit(".html.gz")))


def _slugs(keep_letters: bool):
    def slug(text: str | None) -> str:
        folded = unicodedata.normalize("NFKD", text or "")
        folded = "".join(c for c in folded if not unicodedata.combining(c)) if keep_letters else folded.encode("ascii", "ignore").decode()
        return re.sub(r"[^a-z0-9]+", "-", folded.lower()).strip("-")

    return slug


def slugify(text: Column, keep_letters: bool = False) -> Column:
    """Small letters and digits joined by `-`. Letters outside ASCII are decomposed first; those left over are dropped, or
    with `keep_letters` end a word. No built-in function decomposes, hence Arrow batches."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slug = _slugs(keep_letters)
        for batch in batches:
            yield batch.map(slug, na_action=None)

    return run(text)
