"""Watermarked variants for pure streams: bounded state, late rows beyond the delay are dropped.

The stored tables are the exact path; these serve consumers that need results in the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe(events: DataFrame, delay: str, time: str = "event_timestamp") -> DataFrame:
    """One row per event id among arrivals within the delay."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_id"])


def per_minute(
    events: DataFrame, delay: str | None, by: list[str], *aggregates: Column,
    time: str = "event_timestamp",
) -> DataFrame:
    """Aggregates per tumbling minute and `by`; no delay if a watermark is already set."""
    if delay is not None:
        events = events.withWatermark(time, delay)
    windowed = events.groupBy(F.window(time, "1 minute").alias("window"), *by).agg(*aggregates)
    return windowed.withColumn("minute", F.col("window.start")).drop("window")


def calls_per_minute(calls: DataFrame, delay: str | None) -> DataFrame:
    return per_minute(
        calls, delay, ["tower_id"],
        F.count("*").alias("call_count"),
        F.count_if("dropped").alias("dropped_count"),
        F.sum("duration_seconds").alias("total_duration"),
    )


def data_per_minute(usage: DataFrame, delay: str | None) -> DataFrame:
    return per_minute(
        usage, delay, ["tower_id", "technology"],
        F.sum(F.col("mb_used").cast("decimal(12,2)")).alias("total_mb"),
        F.count("*").alias("session_count"),
    )


def revenue_per_minute(revenue: DataFrame, delay: str | None) -> DataFrame:
    """Revenue events that already carry province, type and amount."""
    return per_minute(
        revenue, delay, ["province", "revenue_type"],
        F.sum(F.col("amount").cast("decimal(10,2)")).alias("total_amount"),
        F.count("*").alias("txn_count"),
    )
