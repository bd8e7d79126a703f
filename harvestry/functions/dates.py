"""Columns made from dates as text. Text is compared as text; nothing here guesses a missing part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")


def iso_like(raw: Column) -> Column:
    """Unquoted; `Y/M/D` and `Y.M.D` written with dashes and two digits; all else unchanged."""
    s = F.regexp_replace(_trimmed(raw), "^[\"']+|[\"']+$", "")
    form = r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})"
    made = F.concat_ws("-", F.regexp_extract(s, form, 1), F.lpad(F.regexp_extract(s, form, 2), 2, "0"), F.lpad(F.regexp_extract(s, form, 3), 2, "0"))
    return F.when(s.rlike(form), made).otherwise(s)


def site_date(date: Column) -> Column:
    """8 and 14 digits as `YYYY-MM-DD`, 6 as `YYYY-MM`, all else trimmed."""
    d = _trimmed(date)
    dashed = F.concat_ws("-", d.substr(1, 4), d.substr(5, 2), d.substr(7, 2))
    return F.when(d.rlike(r"^(?:\d{8}|\d{14})$"), dashed).when(d.rlike(r"^\d{6}$"), F.concat_ws("-", d.substr(1, 4), d.substr(5, 2))).otherwise(d)


def year_of(date: Column) -> Column:
    return F.when(date.rlike(r"^\d{4}"), date.substr(1, 4).cast("int"))


def stated_year(value: Column) -> Column:
    """The year from 1900 to 2099 that a value begins with, '' if none; more digits after it are no year."""
    return F.regexp_extract(F.coalesce(value, F.lit("")), r"^((?:20|19)\d\d)(?!\d)", 1)


def days_between(a: Column, b: Column) -> Column:
    """Days from a to b of two timestamps of 8 digits or more; null for other text."""
    day = lambda c: F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd")
    return F.datediff(day(b), day(a))


def day_of(date: Column) -> Column:
    return F.when(F.length(date) >= 10, F.left(date, F.lit(10))).otherwise(date)


def full_date(date: Column) -> Column:
    """The date if it begins as YYYY-MM-DD, else ''."""
    return F.when(F.coalesce(date, F.lit("")).rlike(r"^\d{4}-\d{2}-\d{2}"), date).otherwise("")


def published(raw: Column) -> Column:
    """A feed's time of publication in ISO form, in its own zone as given; other text unchanged.

    Takes the forms of mail headers with a numeric or GMT zone and of ISO; GMT names no offset in the result.
    """
    r = _trimmed(raw)
    form = r"^(?:[A-Za-z]{3},?\s+)?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}:\d{2}:\d{2}) ([+-]\d{4}|GMT)$"
    month = F.lpad(F.ceil(F.instr(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), F.regexp_extract(r, form, 2)) / 3).cast("string"), 2, "0")
    zone = F.regexp_extract(r, form, 5)
    shown = F.when(zone == "GMT", "").otherwise(F.concat(zone.substr(1, 3), F.lit(":"), zone.substr(4, 2)))
    made = F.concat(F.regexp_extract(r, form, 3), F.lit("-"), month, F.lit("-"), F.lpad(F.regexp_extract(r, form, 1), 2, "0"), F.lit("T"), F.regexp_extract(r, form, 4), shown)
    return F.when(r.rlike(form), made).otherwise(r)
