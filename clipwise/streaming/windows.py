"""Structured Streaming: windowed counts over a file stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def as_utc(ts: Column) -> Column:
    """The instant that a timestamp without zone names in UTC, as watermarks need one."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts))


def as_local(ts: Column) -> Column:
    """The inverse of ``as_utc``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def windowed_counts(events: DataFrame, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Counts and sums by window and event type; the same on a batch and on a stream.

    On a stream, a window is emitted once no row can come that is at most ``delay`` late, and later rows are dropped.
    """
    stamped = events.withColumn("ts", as_utc(F.col("ts")))
    if events.isStreaming:
        stamped = stamped.withWatermark("ts", delay)
    counts = stamped.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counts.select(as_local(F.col("window.start")).alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Sessions by user: start, end of the last event, events and their sum; an event within ``gap`` of the one before joins it."""
    stamped = events.withColumn("ts", as_utc(F.col("ts")))
    if events.isStreaming:
        stamped = stamped.withWatermark("ts", delay)
    grouped = stamped.groupBy("user_id", F.session_window("ts", gap)).agg(F.max("ts").alias("last"), F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select("user_id", as_local(F.col("session_window.start")).alias("start"), as_local(F.col("last")).alias("last"), "n", "total")


def sliding_levels(events: DataFrame, width: str = "2 days", step: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Root mean square of values in windows that overlap."""
    stamped = events.withColumn("ts", as_utc(F.col("ts")))
    if events.isStreaming:
        stamped = stamped.withWatermark("ts", delay)
    grouped = stamped.groupBy(F.window("ts", width, step), "event_type").agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("level"), F.count("*").alias("n"))
    return grouped.select(as_local(F.col("window.start")).alias("start"), "event_type", "level", "n")


def stream_to_table(spark: SparkSession, source: str, out: str, checkpoint: str, *, schema: str = EVENTS, names: str = "*.parquet", width: str = "1 day") -> DataFrame:
    """Takes what has arrived under ``source``, appends closed windows to ``out`` and returns that table.

    The checkpoint makes a rerun take only new files, and a lost executor costs no result.
    """
    stream = spark.readStream.schema(schema).option("pathGlobFilter", names).parquet(source)
    query = (
        windowed_counts(stream, width)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)
