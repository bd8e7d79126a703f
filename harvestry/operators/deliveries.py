"""Problem 4: messages delivered at least once, kept exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_blank
from ..session import free_name

#: An archive's address in front of the address of a page, as in wayback_url.
ARCHIVE_PREFIX = r"(?i)^(?:\s*https?://[^/?#]*archive[^/?#]*/web/\d{1,14}(?:[a-z]{2}_)?/)+"


def post_key(url: Column) -> Column:
    """The address of a post: no white space around it, no archive address in front; null stays null."""
    return strip_blank(F.regexp_replace(strip_blank(url), ARCHIVE_PREFIX, ""))


def first_deliveries(df: DataFrame, identifier: Column, delivered: Column, tie: str) -> DataFrame:
    """One row (`tie` of the surviving delivery) per identifier: earliest `delivered`, null last, then smallest `tie`.

    min_by over (has no time, time, tie) is a partial aggregate: every task sends one row per identifier, so an
    identifier with a third of all rows costs no more than any other. Null identifiers give no row.
    """
    return (
        df.select(identifier.alias("post"), delivered.alias("at"), F.col(tie).alias("row"))
        .filter(F.col("post").isNotNull())
        .groupBy("post")
        .agg(F.min_by("row", F.struct(F.col("at").isNull().alias("late"), "at", "row")).alias(tie))
        .select(tie)
    )


def keep_one_delivery(df: DataFrame, identifier: Column, delivered: Column, tie: str) -> DataFrame:
    """`df` without repeated deliveries; rows without an identifier are not kept. `tie` must be unique.

    Empty input gives empty output; other columns pass through whatever their names.
    """
    return df.join(first_deliveries(df, identifier, delivered, tie), tie, "left_semi")


def repeated_deliveries(df: DataFrame, identifier: Column, delivered: Column, tie: str) -> DataFrame:
    """The rows that `keep_one_delivery` drops, without those that have no identifier."""
    name = free_name(df, "post")
    rows = df.withColumn(name, identifier).filter(F.col(name).isNotNull()).drop(name)
    return rows.join(first_deliveries(df, identifier, delivered, tie), tie, "left_anti")
