"""Windows over event streams. An extension: the same functions work on a stream and on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def late_after(events: DataFrame, delay: str | None, ts: str = "ts") -> DataFrame:
    """With a watermark on streams; tables have no late rows."""
    return events.withWatermark(ts, delay) if delay and events.isStreaming else events


def tumbling(events: DataFrame, width: str, delay: str | None = "10 minutes", ts: str = "ts", key: str = "event_type", value: str = "value") -> DataFrame:
    rows = late_after(events, delay, ts).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return rows.select(F.col("window.start").alias("window_start"), key, "n", "total")


def sliding(events: DataFrame, width: str, step: str, delay: str | None = "10 minutes", ts: str = "ts", key: str = "event_type", value: str = "value") -> DataFrame:
    rows = late_after(events, delay, ts).groupBy(F.window(ts, width, step), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return rows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "n", "total")


def sessions(events: DataFrame, gap: str, delay: str | None = "10 minutes", ts: str = "ts", key: str = "user_id") -> DataFrame:
    """A user's events with less than ``gap`` between them; Spark merges session windows without gathering a user's rows."""
    rows = late_after(events, delay, ts).groupBy(key, F.session_window(ts, gap)).agg(F.max(ts).alias("last_event"), F.count("*").alias("n"))
    return rows.select(key, F.col("session_window.start").alias("session_start"), "last_event", "n")


def first_seen(events: DataFrame, keys: list[str], delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Each key once; on a stream within the watermark, so that state stays bounded."""
    return late_after(events, delay, ts).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)
