"""An extension: event counts by window from a stream. The batch model that this library follows has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "2 hours", time: str = "ts") -> DataFrame:
    """(start, event_type, n, total) by tumbling window; rows later than `late` behind the newest are left out."""
    stamped = events.withColumn(time, F.col(time).cast("timestamp"))
    if events.isStreaming:
        stamped = stamped.withWatermark(time, late)
    made = stamped.groupBy(F.window(time, length).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return made.select(F.col("w.start").alias("start"), "event_type", "n", "total")
