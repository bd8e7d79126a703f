"""Streaming jobs: event counts by window, and an index kept up to date by increments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, lateness: str = "1 day", size: str = "1 hour") -> DataFrame:
    """(window_start, event_type, n, total): events by window of `size`; later ones than `lateness` are dropped in a stream."""
    at = events.withColumn("at", F.col("ts").cast("timestamp"))
    return (at.withWatermark("at", lateness) if events.isStreaming else at).groupBy(F.window("at", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def partial_index(observations: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """What an increment tells of each key, in a form that can be merged in any order: extremes and counts."""
    at = F.struct(F.coalesce(ts, F.lit("")).alias("ts"), (-F.col(seq)).alias("first"))
    return observations.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(ts).alias("first_ts"), F.max(at).alias("latest"), F.count("*").alias("n"))


def merged_partials(partials: DataFrame, key: str) -> DataFrame:
    return partials.groupBy(key).agg(F.min("first_ts").alias("first_ts"), F.max("latest").alias("latest"), F.sum("n").alias("n"))


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], folder: str, mode: str = "append") -> None:
    """Run a stream over what is there, batch by batch, with its progress in `folder`; run again, it goes on from there."""
    query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", folder).trigger(availableNow=True).start()
    query.awaitTermination()


def keep_index(spark: SparkSession, source: DataFrame, folder: str, key: str, ts: str, seq: str) -> DataFrame:
    """The index of all observations that `source`, a stream, has brought so far.

    Every batch is reduced to partials of its own, which a repeat after a failure overwrites, so it counts once. Nothing
    written before is read or written again; the partials of a key are merged when the index is read.
    """

    def keep(batch: DataFrame, number: int) -> None:
        partial_index(batch, key, ts, seq).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    run_available(source, keep, f"{folder}/progress")
    partials = spark.read.option("basePath", folder).parquet(f"{folder}/batch=*")
    return merged_partials(partials, key).select(key, "first_ts", F.col("latest.ts").alias("last_ts"), (-F.col("latest.first")).alias(f"latest_{seq}"), "n")
