"""Streaming forms of the run log's operators (extensions; the batch forms are the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_urls(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """First sight of each url within the watermark; state is bounded by the delay."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["url"])


def windowed_counts(events: DataFrame, width: str = "1 day", slide: str | None = None, delay: str = "1 hour", key: str = "event_type") -> DataFrame:
    """Tumbling or sliding counts by key; works on batch and streaming input."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    out = events.withWatermark("ts", delay).groupBy(w.alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), key, "n")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour", key: str = "user_id") -> DataFrame:
    """Runs of a key's events less than ``gap`` apart; a session ends ``gap`` after its last event.

    Start and end are aggregates: as fields of the session window, a filter on
    them would be pushed below the merging of sessions.
    """
    end = (F.max("ts") + F.expr(f"INTERVAL {gap}")).alias("session_end")
    out = events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap), key)
    return out.agg(F.min("ts").alias("session_start"), end, F.count("*").alias("n")).select(key, "session_start", "session_end", "n")
