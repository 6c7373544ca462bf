"""Windowed aggregates that run alike over tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(events: DataFrame, size: str, slide: str | None = None, late: str = "10 minutes", time: str = "ts") -> DataFrame:
    """(start, end, event_type, n, value): counts and whole sums in tumbling or sliding windows.  A stream gets a watermark of `late`."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    by = rows.groupBy(F.window(time, size, slide) if slide else F.window(time, size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("value")).alias("value"))
    return by.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", key: str = "user_id", late: str = "10 minutes", time: str = "ts") -> DataFrame:
    """(key, start, end, n): runs of events with no gap as long as `gap`."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    by = rows.groupBy(F.session_window(time, gap), key).agg(F.count(F.lit(1)).alias("n"))
    return by.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def person_counts(papers: DataFrame, late: str = "1 day", time: str = "ts") -> DataFrame:
    """Paper counts of each person that grow with a stream of papers (update or complete output)."""
    rows = papers.withWatermark(time, late) if papers.isStreaming else papers
    return rows.groupBy("person").agg(F.count(F.lit(1)).alias("papers"), F.max(time).alias("last"))
