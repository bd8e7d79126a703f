"""Problem 7: fields that pack several values, split into one row per value with its position.

Built-in regular expressions keep single values out of Python; the rest goes through a finite-state tokenizer in Arrow
batches. The tokenizer knows three states (between values, in a plain value, in a quoted value) and the nesting depth of
brackets; delimiters count only outside quotes and at depth 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import free_name

#: Characters and words between values, and the quotes that may enclose one.
DELIMITERS = ";|/,\t\n\r•·+&"
WORDS = ("and", "with")
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "«": "»", "„": "“"}
BRACKETS = {"(": ")", "[": "]", "{": "}"}
CREDIT = r"(?i)^(?:[-–—]+\s*)?(?:(?:(?:written|edited|reported|compiled|produced|posted|story|words|text|analysis)\s+)?by\b:?\s*)?"
_BLANK = "               ​‌‍    ⁠　﻿\x1c\x1d\x1e\x1f"
_AMP = re.compile(r"&(?:amp|#38|#x26);", re.I)
_STOPS = re.compile(r"[" + re.escape(DELIMITERS + "()[]{}") + r"]|(?<=\s)(?:" + "|".join(WORDS) + r")(?=\s)", re.I)


def _near(a: str, b: str) -> bool:
    """Equal up to one slip: a letter changed, lost, added, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 3:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[1::-1] and x[2:] == y[2:])


def _compound(text: str, start: int, end: int, compounds: list[tuple[str, str]]) -> bool:
    """Whether the delimiter at text[start:end] belongs to a name such as `News and Sports Network`."""
    left, right = re.findall(r"\w+", text[max(0, start - 40) : start].lower()), re.findall(r"\w+", text[end : end + 40].lower())
    return bool(left and right) and any(_near(left[-1], a) and _near(right[0], b) for a, b in compounds)


def split_packed(text: str | None, compounds: list[tuple[str, str]] = []) -> list[str]:  # noqa: B006
    """The values of one field in order; none for a null or blank field, empty places left out.

    A value in quotes ends at the closing quote before a delimiter or the end; a doubled or backslashed quote inside
    stands for one. Anything unbalanced is taken as written.
    """
    if text is None:
        return []
    text = _AMP.sub("&", text).strip(_BLANK)
    while len(text) > 1 and text[0] in BRACKETS and text[-1] == BRACKETS[text[0]] and text[0] not in text[1:]:
        text = text[1:-1].strip(_BLANK)
    text = re.sub(CREDIT, "", text)
    out: list[str] = []
    at, size = 0, len(text)
    while at < size:
        while at < size and text[at] in _BLANK:
            at += 1
        if at >= size:
            break
        quoted = _quoted(text, at) if text[at] in QUOTES else None
        if quoted:
            value, at = quoted
            out.append(value)
        else:
            end, after = _plain_end(text, at, compounds)
            out.append(text[at:end])
            at = after
            continue
        stop = _STOPS.match(text, _skip(text, at))
        at = stop.end() if stop else size
    values = [v.strip(_BLANK) for v in out]
    return [v for v in values if v and any(c.isalnum() for c in v)]


def _skip(text: str, at: int) -> int:
    while at < len(text) and text[at] in _BLANK and text[at] not in DELIMITERS:
        at += 1
    return at


def _quoted(text: str, at: int) -> tuple[str, int] | None:
    """The value in quotes that begins here and the place after it; None if its quote isn't closed before a delimiter."""
    close, kept, i = QUOTES[text[at]], [], at + 1
    while i < len(text):
        c = text[i]
        if c == "\\" and i + 1 < len(text) and text[i + 1] in (close, "\\"):
            kept.append(text[i + 1])
            i += 2
        elif c == close:
            rest = _skip(text, i + 1)
            if rest >= len(text) or _STOPS.match(text, rest) and text[rest] not in "([{":
                return "".join(kept), i + 1
            if text[i + 1 : i + 2] == close:
                kept.append(c)
                i += 2
            else:
                kept.append(c)
                i += 1
        else:
            kept.append(c)
            i += 1
    return None


def _plain_end(text: str, at: int, compounds: list[tuple[str, str]]) -> tuple[int, int]:
    """Where the plain value that begins here ends, and where the next place begins."""
    depth, i = 0, at
    first = re.compile(r"(?:" + "|".join(WORDS) + r")(?=\s)", re.I).match(text, at)
    if first:
        return at, first.end()
    while stop := _STOPS.search(text, i):
        c = stop.group()
        i = stop.end()
        if c in BRACKETS:
            depth += 1
        elif c in ")]}":
            depth = max(0, depth - 1)
        elif depth == 0 or c in "\n\r":
            if (c == "&" or c.isalpha()) and _compound(text, stop.start(), stop.end(), compounds):
                continue
            return stop.start(), stop.end()
    return len(text), len(text)


def one_reversed(values: list[str], text: str) -> bool:
    """Whether two values around one comma are one name written surname (or distinguishing part) first."""
    if len(values) != 2 or text.count(",") != 1 or re.search(r",\s*(?:" + "|".join(WORDS) + r")\s", text, re.I) or any(c in text for c in ";|/\t\n•·+&\""):
        return False
    left, right = (re.findall(r"[^\s_]+", v) for v in values)
    if len(right) == 1:
        acronym = re.match(r"[A-Z]{3,4}$" if values[0].isupper() else r"[A-Z]{3,6}$", right[0])
        return not (len(left) >= 2 and acronym)
    return len(left) == 1 and len(right) == 2 and (len(right[1].rstrip(".")) == 1)


def packed_names(text: str | None, compounds: list[tuple[str, str]] = []) -> list[str]:  # noqa: B006
    """`split_packed` for names: one reversed name alone is one value."""
    values = split_packed(text, compounds)
    if len(values) == 2 and one_reversed(values, text or ""):
        body = re.sub(CREDIT, "", (text or "").strip(_BLANK)).strip(_BLANK)
        return [body.strip("\"'“”‘’")]
    return values


def names_udf(compounds: list[tuple[str, str]]):
    @F.pandas_udf("array<string>")
    def names(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: packed_names(x, compounds))

    return names


#: Most pairs of words around `and` that a dimension table of names may have.
MOST_COMPOUNDS = 100_000


def may_hold_several(text: Column) -> Column:
    return text.rlike(r"[;|/,\t\n\r•·+&]|(?i)\s(?:" + "|".join(WORDS) + r")\s")


def compound_pairs(names: DataFrame, name: str) -> list[tuple[str, str]]:
    """The words around `and` inside the names of a dimension table, as (before, after).

    The table must be of bounded size: more than MOST_COMPOUNDS such pairs are an error, since every task gets them all.
    """
    around = F.regexp_extract_all(F.lower(name), F.lit(r"(\w+) (?:and|with|&) \w+"), 1), F.regexp_extract_all(F.lower(name), F.lit(r"\w+ (?:and|with|&) (\w+)"), 1)
    pairs = names.select(F.explode(F.arrays_zip(around[0].alias("a"), around[1].alias("b"))).alias("p")).select("p.a", "p.b").distinct()
    found = pairs.limit(MOST_COMPOUNDS + 1).collect()
    if len(found) > MOST_COMPOUNDS:
        raise ValueError(f"more than {MOST_COMPOUNDS} names with a joining word; the names are no dimension table")
    return sorted((r.a, r.b) for r in found)


def unpack(df: DataFrame, column: str, compounds: list[tuple[str, str]], least: int = 1) -> DataFrame:
    """One row per value of `column`, with `pos` from 1 and `item`, of the rows with `least` values or more.

    Other columns stay; a null or blank field gives no row; repeats and empty places are kept and dropped in that order.
    """
    name = free_name(df, "values_of_field")
    rows = df.filter(may_hold_several(F.col(column))) if least > 1 else df.filter(F.col(column).isNotNull())
    rows = rows.withColumn(name, names_udf(compounds)(F.col(column))).filter(F.size(name) >= least)
    kept = [c for c in df.columns]
    return rows.select(*kept, F.posexplode(name).alias("pos", "item")).withColumn("pos", F.col("pos") + 1)
