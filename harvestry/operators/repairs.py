"""Values written back by later fetches, only where they mend something."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_blanks(value: Column, new: Column) -> Column:
    """`new` where `value` is null or blank and `new` isn't null, else `value`."""
    return F.when(F.coalesce(F.trim(value), F.lit("")) == "", F.coalesce(new, value)).otherwise(value)


def take_longer(value: Column, new: Column) -> Column:
    """`new` where it is strictly longer than `value` (null has no length), else `value`: a fuller date, never a poorer one."""
    return F.when(F.length(F.coalesce(new, F.lit(""))) > F.length(F.coalesce(value, F.lit(""))), new).otherwise(value)
