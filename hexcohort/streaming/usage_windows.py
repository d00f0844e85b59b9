"""Watermarked streaming version of the time-of-day shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort.operators.mobility_events import day_part


def time_bucket_stream(events: DataFrame, window: str = "30 days", delay: str = "1 day", user: str = "user_id",
                       ts: str = "ts", value: str = "value") -> DataFrame:
    """Shares of each user's volume per part of the day and time window.

    State per user and window is five sums; the watermark drops windows that can
    no longer change.
    """
    parts = ("morning", "afternoon", "evening", "night")
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    part = day_part(F.col(ts))
    agg = timed.groupBy(F.window(ts, window), user).agg(
        F.sum(value).alias("all_"),
        *[F.sum(F.when(part == p, F.col(value)).otherwise(F.lit(0.0))).alias(p) for p in parts])
    return agg.select(F.col("window.start").alias("window_start"), user,
                      *[F.try_divide(F.col(p), F.col("all_")).alias(f"{p}_data_ratio") for p in parts])
