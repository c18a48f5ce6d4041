"""Usage counters over a stream of events (optional mapping of the month-to-date counters)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_usage(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events a day and type.  Works on streams and tables alike; on a stream, days close ``late`` after
    their end and later events are left out, so that state stays bounded.  Events without a time are left out."""
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type").withWatermark("ts", late)
    return timed.groupBy(F.window("ts", "1 day").alias("day"), "event_type").agg(F.count("*").alias("n")).select(F.col("day.start").alias("day"), "event_type", "n")
