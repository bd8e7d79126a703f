"""Joins of rows with one record per group, where one group may hold a third of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A group counts as hot from this share of all rows on, so there are at most HOT_GROUPS of them.
HOT_GROUPS = 128


def attach_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int | Column) -> DataFrame:
    """Inner join of `rows` to `groups` (one row per `keys`, with its number of rows in `size`).

    Groups of more than total / HOT_GROUPS rows number at most HOT_GROUPS, so these are broadcast and their rows
    never shuffle; all other groups are small enough for an ordinary shuffle join.
    """
    limit = F.lit(total) / F.lit(HOT_GROUPS) if isinstance(total, int) else total / F.lit(HOT_GROUPS)
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    marks = hot.select(*keys, F.lit(True).alias("__hot"))
    in_hot = rows.join(F.broadcast(hot), keys)
    in_cold = rows.join(F.broadcast(marks), keys, "left_anti").join(cold, keys)
    return in_hot.unionByName(in_cold)


def look_up(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of `rows` to `groups` (at most one row per `keys`), whatever share of the rows one key holds.

    The rows of each key are counted first; keys of more than 1 / HOT_GROUPS of all rows number less than HOT_GROUPS, so
    these are broadcast with what `groups` has for them. Rows with a null key find nothing and aren't shuffled.
    """
    complete = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    keyed = rows.filter(complete)
    total = keyed.count()
    hot = keyed.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") * HOT_GROUPS > total).drop("__n")
    in_hot = keyed.join(F.broadcast(hot.join(groups, keys, "left")), keys)
    in_cold = keyed.join(F.broadcast(hot), keys, "left_anti").join(groups, keys, "left")
    return in_hot.unionByName(in_cold).unionByName(rows.filter(~complete), allowMissingColumns=True)
