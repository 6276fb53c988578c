"""Minute rollups: sums over any set of facts, which add up to the sums over all of them.

A batch sums its own new facts only. The stored rollup is the sum of these partial ones, folded when read
and when segments are merged; no stored fact is read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.functions import times
from signalmart.sources.mart import Mart


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date_key", times.date_key_of("minute"))


def revenue_events(mart: Mart) -> DataFrame:
    """Airtime and bundle revenue as one relation with a type tag."""
    airtime = mart["fact_recharges"].select(
        "subscriber_key", "event_timestamp", "amount", F.lit("AIRTIME").alias("revenue_type")
    )
    bundle = mart["fact_bundle_sales"].select(
        "subscriber_key",
        "event_timestamp",
        F.col("price").alias("amount"),
        F.lit("BUNDLE").alias("revenue_type"),
    )
    return airtime.unionByName(bundle)


def revenue_minute(mart: Mart) -> DataFrame:
    """Summed per subscriber first, so that a hot one joins its province with a row a minute."""
    provinces = mart["dim_subscriber"].select("subscriber_key", "province")
    return _dated(
        revenue_events(mart)
        .groupBy(times.minute_of("event_timestamp").alias("minute"), "subscriber_key", "revenue_type")
        .agg(F.sum("amount").alias("total_amount"), F.count("*").alias("txn_count"))
        .join(provinces, "subscriber_key")
        .groupBy("minute", "province", "revenue_type")
        .agg(
            F.sum("total_amount").cast("decimal(14,2)").alias("total_amount"),
            F.sum("txn_count").alias("txn_count"),
        )
    )


def calls_minute(mart: Mart) -> DataFrame:
    return _dated(
        mart["fact_calls"]
        .groupBy(times.minute_of("event_timestamp").alias("minute"), "tower_key")
        .agg(
            F.count("*").alias("call_count"),
            F.count_if("dropped").alias("dropped_count"),
            F.sum("duration_seconds").alias("total_duration"),
        )
    )


def data_minute(mart: Mart) -> DataFrame:
    return _dated(
        mart["fact_data_usage"]
        .groupBy(times.minute_of("event_timestamp").alias("minute"), "tower_key", "technology")
        .agg(
            F.sum("mb_used").cast("decimal(16,2)").alias("total_mb"),
            F.count("*").alias("session_count"),
        )
    )


def dlq_minute(mart: Mart) -> DataFrame:
    return _dated(
        mart["dlq_records"]
        .groupBy(
            times.minute_of("rejected_at").alias("minute"), "source_topic", "rejection_reason"
        )
        .agg(F.count("*").alias("record_count"))
    )


# rollup table -> (builder, tables whose rows it sums)
FACT_ROLLUPS: dict[str, tuple[Callable[[Mart], DataFrame], tuple[str, ...]]] = {
    "agg_revenue_minute": (revenue_minute, ("fact_recharges", "fact_bundle_sales")),
    "agg_calls_minute": (calls_minute, ("fact_calls",)),
    "agg_data_minute": (data_minute, ("fact_data_usage",)),
}
DLQ_ROLLUPS = {"agg_dlq_minute": (dlq_minute, ("dlq_records",))}


def affected_minutes(events: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """First and last touched minute and the exclusive end of the range, as one row."""
    bounds = events.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    last = times.minute_of("_hi")
    return bounds.select(
        times.minute_of("_lo").alias("lo"),
        last.alias("hi"),
        (last + times.minutes(1)).alias("hi_next"),
    )


#: Sums of each rollup with their stored types; the other columns are its key.
SUMS = {
    "agg_revenue_minute": {"total_amount": "decimal(14,2)", "txn_count": "bigint"},
    "agg_calls_minute": {"call_count": "bigint", "dropped_count": "bigint", "total_duration": "bigint"},
    "agg_data_minute": {"total_mb": "decimal(16,2)", "session_count": "bigint"},
    "agg_dlq_minute": {"record_count": "bigint"},
}


def fold(name: str, partial: DataFrame) -> DataFrame:
    """One row per key from partial rollups."""
    sums = SUMS[name]
    key = [column for column in partial.columns if column not in sums]
    folded = partial.groupBy(*key).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in sums.items()])
    return folded.select(*partial.columns)
