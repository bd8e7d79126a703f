"""Captures and sightings merged into an index, and the index rolled up into pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .choose import first_rows
from .skew import attach_groups

#: Kinds of pages that make up the editorial corpus.
EDITORIAL = ("article", "liveblog", "project", "podcast", "video", "methodology")


def _filled(c: str) -> Column:
    return F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))


def merged_index(observations: DataFrame) -> DataFrame:
    """One row per `urlkey` of (urlkey, url, ts, status, mimetype, digest, length, origin, seq).

    The first filled url by seq; the earliest and latest filled ts; of the first row at the latest ts status, type, digest
    and length; the number of capture rows; the origins, sorted and joined by `+`. All are partial aggregates. Rows with
    a blank key are dropped; rows with a blank ts count but give no latest values.
    """
    rows = observations.filter(F.coalesce(F.col("urlkey"), F.lit("")) != "")
    at = F.when(_filled("ts").isNotNull(), F.struct(_filled("ts").alias("ts"), (-F.col("seq")).alias("first")))
    latest = [F.max_by(F.coalesce(c, F.lit("")), at).alias(f"latest_{c}") for c in ("status", "mimetype", "digest", "length")]
    merged = rows.groupBy("urlkey").agg(
        F.min_by("url", F.when(_filled("url").isNotNull(), F.col("seq"))).alias("url"),
        F.min(_filled("ts")).alias("first_seen_ts"),
        F.max(_filled("ts")).alias("last_seen_ts"),
        *latest,
        F.count_if(F.col("origin") == "cdx").alias("observations"),
        F.array_join(F.array_sort(F.collect_set("origin")), "+").alias("source"),
    )
    return merged


def qualifies() -> Column:
    """A page that answered with HTML, or an article or podcast known from a sitemap or feed only."""
    status, kind = F.coalesce(F.col("latest_status"), F.lit("")), F.coalesce(F.col("latest_mimetype"), F.lit(""))
    listed = F.col("kind").isin("article", "podcast") & (F.contains("source", F.lit("sitemap")) | F.contains("source", F.lit("feed")))
    return ((status == "200") & (kind == "text/html")) | ((status == "") & (kind == "") & listed)


#: Columns of the row whose address stands for a page.
ADDRESS = ("url", "canonical_key", "host", "path")


def rolled_up(index: DataFrame, order: str) -> DataFrame:
    """One row per rollup_key of qualifying editorial rows.

    The address with the fewest slashes stands for a page, then the shortest, then the first by `order`; for the address of
    projects see `project_address`. With the address go its canonical_key, host and path.
    """
    rows = index.filter(F.col("kind").isin(*EDITORIAL) & qualifies())
    at = F.struct(F.coalesce(_filled("last_seen_ts"), F.lit("")).alias("ts"), (-F.col(order)).alias("first"))
    short = F.struct(F.size(F.split("url", "/")).alias("slashes"), F.length("url").alias("size"), F.col(order).alias("first"))
    pages = rows.groupBy("rollup_key").agg(
        F.min_by("kind", order).alias("kind"),
        F.min_by(F.struct(*ADDRESS), F.when(_filled("url").isNotNull(), short)).alias("address"),
        F.min(_filled("first_seen_ts")).alias("first_seen_ts"),
        F.max(_filled("last_seen_ts")).alias("last_seen_ts"),
        F.count("*").alias("member_url_count"),
        F.max_by("latest_status", at).alias("latest_status"),
        F.max_by("latest_mimetype", at).alias("latest_mimetype"),
    )
    projects = project_address(index, order).select("rollup_key", F.struct(*ADDRESS).alias("project"))
    chosen = F.when(F.col("kind") == "project", F.coalesce("project", "address")).otherwise(F.col("address"))
    return pages.join(projects, "rollup_key", "left").withColumn("address", chosen).select("rollup_key", "kind", "address.*", "first_seen_ts", "last_seen_ts", "member_url_count", "latest_status", "latest_mimetype")


def project_address(index: DataFrame, order: str) -> DataFrame:
    """(rollup_key, url, canonical_key, host, path) of projects.

    Going through a project's addresses by `order`, one replaces the kept one if it has fewer slashes, or as many and is
    shorter, or ends with a slash where the kept one doesn't. The last test makes the outcome depend on the order, so the
    places where the kept address changes are found in rounds, each an aggregation with partial results: from one that ends
    with a slash only the smallest of those to come can take over, from another the next that ends with a slash. Rounds
    end when no project changes; few change more than once.
    """
    rows = index.filter((F.col("kind") == "project") & qualifies() & _filled("url").isNotNull()).groupBy("rollup_key", "url").agg(F.min_by(F.struct(*ADDRESS[1:]), order).alias("rest"), F.min(order).alias("at"))
    place = F.struct(F.size(F.split("url", "/")).alias("slashes"), F.length("url").alias("size"), "at")
    rows = checkpoint(rows.select("rollup_key", F.struct("url", "rest.*", place.alias("place"), F.endswith("url", F.lit("/")).alias("ends")).alias("address")))
    kept = rows.groupBy("rollup_key").agg(F.min_by("address", "address.place").alias("kept"), F.count("*").alias("n"))
    total = rows.count()
    while True:
        kept = checkpoint(kept)
        later = attach_groups(rows, kept, ["rollup_key"], "n", total).filter(F.col("address.place.at") > F.col("kept.place.at"))
        smaller = (F.col("address.place.slashes") < F.col("kept.place.slashes")) | ((F.col("address.place.slashes") == F.col("kept.place.slashes")) & (F.col("address.place.size") < F.col("kept.place.size")))
        takes = later.filter(F.when(F.col("kept.ends"), smaller).otherwise(F.col("address.ends") | smaller))
        best = F.when(F.col("kept.ends"), F.struct(F.col("address.place.slashes").alias("a"), F.col("address.place.size").alias("b"), F.col("address.place.at").alias("c"))).otherwise(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("address.place.at").alias("c")))
        new = checkpoint(takes.groupBy("rollup_key").agg(F.min_by("address", best).alias("new")))
        if new.isEmpty():
            return kept.select("rollup_key", *[F.col(f"kept.{c}").alias(c) for c in ADDRESS])
        kept = kept.join(new, "rollup_key", "left").select("rollup_key", F.coalesce("new", "kept").alias("kept"), "n")


def duplicate_groups(df: DataFrame, key: str, order: str, sample: int = 5) -> DataFrame:
    """(key, url_count, host_count, sample_urls) of the values of `key` that two or more rows share.

    Null, blank, `-` and `0` are no values. The sample is the first `sample` addresses; each task sends no more per group.
    """
    rows = df.filter(F.coalesce(F.col(key), F.lit("")).isin("", "-", "0") == F.lit(False))
    counts = rows.groupBy(key).agg(F.count("*").alias("url_count"), F.count_distinct("host").alias("host_count")).filter("url_count > 1")
    few = first_rows(rows.select(key, "url", order), [key], [F.asc(order)], sample)
    lists = few.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "url"))), lambda x: F.coalesce(x["url"], F.lit(""))), " ").alias("sample_urls"))
    return counts.join(lists, key)
