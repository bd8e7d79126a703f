"""The orders in which lists are shown. Text is compared as a reader's alphabet has it, without case and accents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A collation without case and accents.
ALPHABET = "UNICODE_CI_AI"


def entry_order(column: str, down: bool, date: str = "date", row: str = "seq") -> list[Column]:
    """Entries by `column`; blank dates come last either way, ties keep the order of `row`."""
    if column == date:
        c = F.nullif(column, F.lit(""))
        return [c.desc_nulls_last() if down else c.asc_nulls_last(), F.asc(row)]
    c = F.collate(F.coalesce(column, F.lit("")), ALPHABET)
    return [c.desc() if down else c.asc(), F.asc(row)]


def episode_order(column: str, down: bool, date: str = "date", title: str = "title", row: str = "seq") -> list[Column]:
    """Episodes by `column`; a blank date counts as after all others, so it comes first downwards. Ties go up by title."""
    c = F.coalesce(F.nullif(column, F.lit("")), F.lit("￿")) if column == date else F.collate(F.coalesce(column, F.lit("")), ALPHABET)
    return [c.desc() if down else c.asc(), F.collate(F.coalesce(title, F.lit("")), "UNICODE").asc(), F.asc(row)]
