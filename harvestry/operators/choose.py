"""Choosing rows and values within groups.

Rows are chosen by a rank filter: Spark cuts every group to the wanted rows in each task before it shuffles them
(WindowGroupLimit), so a group with a third of all rows sends a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import free_name


def first_rows(df: DataFrame, keys: list[Column | str], order: list[Column], n: int = 1) -> DataFrame:
    """The first `n` rows of each group by `order`, which should end in a unique column; null keys are one group."""
    rank = free_name(df, "rank_in_group")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n).drop(rank)


def last_row_wins(df: DataFrame, keys: list[Column | str], seq: str) -> DataFrame:
    """The latest row of each key of an append-only log."""
    return first_rows(df, keys, [F.desc(seq)])


def unique_or_nothing(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """(key, value) of the keys that have exactly one distinct value; null and blank ones don't count."""
    pairs = df.select(key.alias("key"), value.alias("value")).filter("key <> '' and value <> ''")
    return pairs.groupBy("key").agg(F.min("value").alias("value"), F.max("value").alias("other")).filter("value = other").drop("other")


def most_frequent(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """(key, value, n): the most frequent filled value of each key; of equally frequent ones the first seen."""
    counted = df.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(key, value).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    return first_rows(counted, [key], [F.desc("n"), F.asc("first")]).drop("first")


def top_counts(df: DataFrame, value: str, seq: str, n: int) -> DataFrame:
    """The `n` most frequent values with their counts, ties by first occurrence; blank ones count as `(unknown)`."""
    named = df.select(F.coalesce(F.nullif(F.col(value), F.lit("")), F.lit("(unknown)")).alias(value), seq)
    counted = named.groupBy(value).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    return counted.orderBy(F.desc("n"), F.asc("first")).limit(n).drop("first")


def spaced_days(df: DataFrame, key: str, day: Column, gap: int) -> DataFrame:
    """(key, day): days kept greedily from the first on, each at least `gap` days after the last one kept.

    What is kept depends on what was kept before, so it is a fold; it runs over the distinct days of a key, of which there
    are as many as the calendar has, not over its rows.
    """
    days = df.select(key, day.alias("day")).filter(F.col("day").isNotNull()).distinct()
    ordered = days.groupBy(key).agg(F.array_sort(F.collect_list("day")).alias("days"))
    empty = F.array().cast("array<date>")
    kept = F.aggregate("days", empty, lambda a, d: F.when((F.size(a) == 0) | (F.datediff(d, F.element_at(F.concat(a, F.array(F.lit("1000-01-01").cast("date"))), F.greatest(F.size(a), F.lit(1)))) >= gap), F.concat(a, F.array(d))).otherwise(a))
    return ordered.select(key, F.explode(kept).alias("day"))
