"""Windowed rates on streams.

All take events with a zone-less ts and return zone-less times, so that results compare to the batch
forms. Append mode holds a window back until the watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators.analytics import error_counts, with_error_rate
from faultline.streaming.jobs import with_event_time, without_zone

def windowed_counts(events: DataFrame, length: str, delay: str) -> DataFrame:
    """Events and errors per service and window, still with the window column the watermark works on."""
    return with_event_time(events, delay).groupBy("service", F.window("ts", length)).agg(*error_counts())


def stream_error_rate(events: DataFrame, length: str, delay: str) -> DataFrame:
    """Q1 on a stream."""
    counted = windowed_counts(events, length, delay)
    flat = counted.select("service", F.col("window.start").alias("window_start"), "total_events", "error_events")
    return without_zone(with_error_rate(flat), "window_start")
