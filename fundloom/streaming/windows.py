"""Windowed aggregation of event streams with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hourly(events: DataFrame) -> DataFrame:
    """Counts and sums per hour and type; the same plan for a batch and a stream."""
    return events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def stream_hourly(spark: SparkSession, path: str, schema, watermark: str = "2 hours") -> DataFrame:
    """A stream of Parquet files of events, aggregated per hour; windows close two hours after the latest event."""
    events = spark.readStream.schema(schema).parquet(path)
    return hourly(events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark))
