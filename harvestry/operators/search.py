"""Search by words, their beginnings and near spellings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of a term's length by which a word may differ. Words are cut at anything but letters and digits; both are
#: assumptions about the site's search, whose library isn't public in the harvested data.
FUZZY = 0.15


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def inverted_index(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(term, field, key, n): how often a word stands in a field of a record."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit("")).alias("text")) for f in fields])
    rows = df.select(key, F.inline(entries)).select(F.explode(words_of(F.col("text"))).alias("term"), "field", key)
    return rows.groupBy("term", "field", key).agg(F.count("*").alias("n"))


def matches(index: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """The keys of records in which every term is met by a word that equals it, begins with it, or nearly equals it.

    The terms are literals, so the index is filtered where it is read and only hits shuffle.
    """
    def fits(t: str) -> Column:
        near = round(FUZZY * len(t))
        return F.col("term").startswith(t) | (F.levenshtein("term", F.lit(t), near) >= 0 if near else F.lit(False))

    hits = index.select(key, *[F.when(fits(t), True).alias(f"t{n}") for n, t in enumerate(terms)])
    found = hits.groupBy(key).agg(*[F.max(f"t{n}").alias(f"t{n}") for n in range(len(terms))])
    return found.filter(reduce(Column.__and__, [F.col(f"t{n}") for n in range(len(terms))])).select(key)
