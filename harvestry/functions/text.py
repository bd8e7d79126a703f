"""Text functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, with the no-break and invisible kinds.
BLANK = r"[\s\u0085  ᠎ -‍    ⁠　﻿]"


def strip_blank(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, f"^{BLANK}+|(?<!{BLANK}){BLANK}+$", "")


def letters_and_digits(text: Column) -> Column:
    """Lower case, with nothing but letters, their marks and digits left."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", "")


def spelling_key(text: Column) -> Column:
    """What stays the same under letter case, white space, punctuation and the order of parameters after `?`.

    The part before the first `?` keeps letters and digits; the parameters, split at `&`, keep theirs and are
    sorted. A string with no letter or digit gives '' and null gives null.
    """
    query = F.regexp_extract(text, r"(?s)^[^?]*\?(.*)$", 1)
    parts = F.filter(F.transform(F.split(query, "[&?]"), letters_and_digits), lambda p: p != "")
    joined = F.when(F.contains(text, F.lit("?")), F.array_join(F.array_sort(parts), "&"))
    return F.when(text.isNotNull(), F.concat_ws("?", letters_and_digits(F.substring_index(text, "?", 1)), F.nullif(joined, F.lit(""))))
