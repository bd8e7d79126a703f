"""Articles published twice, resolved to the records that stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .choose import first_rows


def canonical_order() -> list[Column]:
    """Which of equal articles is preferred: an article, signed, no revision, no query, the longest and last key."""
    url, key = F.coalesce("url", F.lit("")), F.col("id")
    flags = [F.col("kind") == "article", F.coalesce("byline", F.lit("")) != "", ~F.contains(key, F.lit("-revision")), ~F.contains(url, F.lit("?"))]
    return [*[F.coalesce(f, F.lit(False)).cast("int").desc() for f in flags], F.length(key).desc(), key.desc(), F.asc("seq")]


def resolve_articles(records: DataFrame, title_key: Column, legacy: Column) -> DataFrame:
    """(seq, byline_seq): the records that stay and the records whose byline they take.

    Articles and videos with a title and a date are one group if title key and day agree; all others stay. A group with at
    most one distinct byline keeps its best record; one that mixes `legacy` with other ids keeps its best record with the
    byline of its best legacy record; any other keeps the best record of each byline, a blank one included. Ranks are
    cut to one row per group in each task, counts are partial aggregates.
    """
    rows = records.select("seq", "id", "kind", "url", F.coalesce("byline", F.lit("")).alias("byline"), title_key.alias("t"), F.left("date", F.lit(10)).alias("d"), F.coalesce(legacy, F.lit(False)).alias("legacy"))
    takes_part = F.col("kind").isin("article", "video") & (F.coalesce("t", F.lit("")) != "") & (F.coalesce("d", F.lit("")) != "")
    grouped, alone = rows.filter(takes_part), rows.filter(~F.coalesce(takes_part, F.lit(False)))
    group = ["t", "d"]
    signed = F.when(F.col("byline") != "", F.col("byline"))
    facts = grouped.groupBy(*group).agg(F.min(signed).alias("b0"), F.max(signed).alias("b1"), F.bool_or("legacy").alias("old"), F.bool_and("legacy").alias("all_old"))
    facts = facts.select(*group, F.when(F.coalesce(F.col("b0") == F.col("b1"), F.lit(True)), "one").when(F.col("old") & ~F.col("all_old"), "mixed").otherwise("each").alias("way"))
    best = first_rows(grouped, group, canonical_order()).select(*group, "seq")
    old = first_rows(grouped.filter("legacy"), group, canonical_order()).select(*group, F.col("seq").alias("byline_seq"))
    each = first_rows(grouped, [*group, "byline"], canonical_order()).select(*group, "seq")
    one = best.join(facts.filter("way = 'one'"), group).select("seq", F.col("seq").alias("byline_seq"))
    mixed = best.join(facts.filter("way = 'mixed'"), group).join(old, group).select("seq", "byline_seq")
    several = each.join(facts.filter("way = 'each'"), group).select("seq", F.col("seq").alias("byline_seq"))
    return one.union(mixed).union(several).union(alone.select("seq", F.col("seq").alias("byline_seq")))
