"""The event log as a stream: counts by event and window, late events bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import fresh_path

EVENT = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE"


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """events: a streaming (or batch) frame with ts and event_type."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")


def run_once(spark: SparkSession, log: str, out: str, **settings) -> DataFrame:
    """Everything the log holds now, window by window once they are closed; state and offsets in the shared folder, so a restart goes on where it stopped."""
    stream = spark.readStream.schema(EVENT).json(log)
    query = (
        windowed_counts(stream, **settings)
        .writeStream.outputMode("append")
        .option("checkpointLocation", f"{out}-state")
        .trigger(availableNow=True)
        .format("parquet")
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out)


def append_log(events: DataFrame, path: str) -> str:
    events.write.mode("append").json(path)
    return path


def counts_of(spark: SparkSession, events: DataFrame) -> DataFrame:
    log = append_log(events, fresh_path(spark, "events"))
    return run_once(spark, log, fresh_path(spark, "counts"))
