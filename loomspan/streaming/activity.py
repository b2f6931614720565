"""Activity counts over streams: an extension, as batches are the rule here. The functions take a streaming or a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity_windows(events: DataFrame, at: str, keys: list[str], ids: list[str], late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events of each window and key, each id once. What is later than the watermark goes; state is dropped with the window.

    A record may come again after its page has moved: dropDuplicatesWithinWatermark keeps the first copy, where the batch's keep_last takes the last.
    """
    stream = events.withWatermark(at, late)
    once = stream.dropDuplicatesWithinWatermark(ids) if events.isStreaming else stream.dropDuplicates(ids)
    counts = once.groupBy(F.window(at, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")
