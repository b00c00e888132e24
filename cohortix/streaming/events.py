"""Streaming ingestion of events: an extension, since the batch rules are the reference behaviour.

The same rules as in batch: the first row of a participant's event counts, late duplicates are
dropped within a watermark, and a source's refresh replaces its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortix.operators.registry import add_events


def first_events(stream: DataFrame, delay: str = "7 days", time: str = "ts") -> DataFrame:
    """One row per participant and event within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["participant_id", "event_id"])


def daily_counts(stream: DataFrame, delay: str = "1 day", time: str = "ts") -> DataFrame:
    """Events and their values by day and type; a day closes when the watermark passes it."""
    w = stream.withWatermark(time, delay).groupBy(F.window(time, "1 day"), "event_type")
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("day"), "event_type", "n", "total")


def visits(stream: DataFrame, gap: str = "12 hours", delay: str = "1 day", time: str = "ts") -> DataFrame:
    """Visits: a participant's events without a longer pause than ``gap``."""
    w = stream.withWatermark(time, delay).groupBy(F.session_window(time, gap), "participant_id")
    return w.agg(F.count("*").alias("n_events")).select("participant_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n_events")


def ingest(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch adds the events that ``table`` (a Parquet folder of versions) lacks."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(batch.schema).parquet(f"{table}/v{batch_id - 1}") if batch_id else batch.limit(0)
        add_events(old, batch.dropDuplicates(["participant_id", "event_id"])).write.mode("overwrite").parquet(f"{table}/v{batch_id}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
