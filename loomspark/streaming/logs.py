"""Streams: tagged log lines, windowed counts over late events, and the newest state per job. Spark-native extension of the log push."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def tag_line(line: Column) -> Column:
    """Lines that don't begin with an ISO date are marked as raw."""
    return F.when(line.rlike(r"^\d{4}-\d{2}-\d{2}"), line).otherwise(F.concat(F.lit("[raw] "), line))


def log_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.text(folder).select(tag_line(F.col("value")).alias("line"))


def event_stream(spark: SparkSession, folder: str, schema: str = EVENT_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and type; works on streams (with a watermark) and tables alike."""
    source = events.withWatermark("ts", late) if events.isStreaming else events
    return source.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("value") * 100).cast("long")).alias("cents")).select(F.col("w.start").alias("start"), "event_type", "n", "cents")


def run_to_memory(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Everything available now, as a table; for tests and demonstrations."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
