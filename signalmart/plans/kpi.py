"""KPI queries over the star schema and its rollups.

Every KPI is `fn(mart, window) -> DataFrame`: `mart` maps table names to DataFrames, `window` holds
the clock of "last hour" tiles and the bounds of time series. Clock and bounds may be literals or
scalar subqueries; literals also prune the day partitions of stored tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart.functions import times
from signalmart.sources.mart import Mart


@dataclass(frozen=True)
class Window:
    as_of: datetime | Column | None = None
    lo: datetime | Column | None = None
    hi: datetime | Column | None = None
    tile_hours: int = 1

    @property
    def clock(self) -> Column:
        return times.as_time(self.as_of)

    def tile(self, df: DataFrame, column: str) -> DataFrame:
        return times.since(df, column, self.clock, self.tile_hours)

    def series(self, df: DataFrame, column: str) -> DataFrame:
        """Default range is the half hour up to the clock."""
        hi = self.clock if self.hi is None else times.as_time(self.hi)
        lo = hi - times.minutes(30) if self.lo is None else times.as_time(self.lo)
        return times.between(df, column, lo, hi)


Kpi = Callable[[Mart, Window], DataFrame]
KPIS: dict[str, Kpi] = {}


def kpi(fn: Kpi) -> Kpi:
    KPIS[fn.__name__] = fn
    return fn


def _total(df: DataFrame, column: str, name: str) -> DataFrame:
    """Sum as one row, zero when there is nothing to sum."""
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias(name))


def _per_minute(df: DataFrame, window: Window, sums: dict[str, str], *by: Column) -> DataFrame:
    """Time-ordered series of summed rollup columns, optionally split by a metric."""
    grouped = window.series(df, "minute").groupBy(F.col("minute").alias("time"), *by)
    return grouped.agg(*[F.sum(src).alias(name) for name, src in sums.items()]).orderBy("time")


# --- Executive -------------------------------------------------------------------------------


@kpi
def kpi_active_subscribers(mart: Mart, window: Window) -> DataFrame:
    return mart["dim_subscriber"].where("is_active").agg(F.count("*").alias("subscribers"))


@kpi
def kpi_revenue_last_hour(mart: Mart, window: Window) -> DataFrame:
    return _total(window.tile(mart["agg_revenue_minute"], "minute"), "total_amount", "revenue")


@kpi
def kpi_calls_last_hour(mart: Mart, window: Window) -> DataFrame:
    return _total(window.tile(mart["agg_calls_minute"], "minute"), "call_count", "calls")


@kpi
def kpi_rejected_last_hour(mart: Mart, window: Window) -> DataFrame:
    return _total(window.tile(mart["agg_dlq_minute"], "minute"), "record_count", "rejected")


@kpi
def kpi_revenue_per_minute(mart: Mart, window: Window) -> DataFrame:
    metric = F.col("revenue_type").alias("metric")
    return _per_minute(mart["agg_revenue_minute"], window, {"value": "total_amount"}, metric)


@kpi
def kpi_calls_per_minute(mart: Mart, window: Window) -> DataFrame:
    sums = {"calls": "call_count", "dropped": "dropped_count"}
    return _per_minute(mart["agg_calls_minute"], window, sums)


@kpi
def kpi_new_subscribers(mart: Mart, window: Window) -> DataFrame:
    return (
        window.series(mart["dim_subscriber"], "created_at")
        .groupBy(times.minute_of("created_at").alias("time"))
        .agg(F.count("*").alias("subscribers"))
        .orderBy("time")
    )


@kpi
def kpi_data_per_minute(mart: Mart, window: Window) -> DataFrame:
    return _per_minute(mart["agg_data_minute"], window, {"mb": "total_mb"})


# --- Network ---------------------------------------------------------------------------------


@kpi
def kpi_tower_status(mart: Mart, window: Window) -> DataFrame:
    return (
        mart["tower_status_current"]
        .join(mart["dim_tower"].select("tower_id", "tower_name"), "tower_id")
        .select(
            F.col("tower_name").alias("tower"),
            F.col("technology").alias("tech"),
            F.col("signal_strength").alias("signal"),
            F.col("connected_devices").alias("devices"),
            "status",
            F.col("updated_at").alias("updated"),
        )
        .orderBy("signal", "tower")
    )


@kpi
def kpi_tower_load(mart: Mart, window: Window) -> DataFrame:
    """Sessions per minute and tower name, summed per key before the names are looked up."""
    by_key = (
        window.series(mart["agg_data_minute"], "minute")
        .groupBy("minute", "tower_key")
        .agg(F.sum("session_count").alias("sessions"))
    )
    names = mart["dim_tower"].select("tower_key", "tower_name")
    return (
        by_key.join(names, "tower_key")
        .groupBy(F.col("minute").alias("time"), F.col("tower_name").alias("metric"))
        .agg(F.sum("sessions").alias("value"))
        .orderBy("time")
    )


@kpi
def kpi_dropped_calls(mart: Mart, window: Window) -> DataFrame:
    return _per_minute(mart["agg_calls_minute"], window, {"dropped": "dropped_count"})


@kpi
def kpi_traffic_by_technology(mart: Mart, window: Window) -> DataFrame:
    metric = F.col("technology").alias("metric")
    return _per_minute(mart["agg_data_minute"], window, {"value": "total_mb"}, metric)


# --- Sales -----------------------------------------------------------------------------------


def _revenue_of(mart: Mart, revenue_type: str) -> DataFrame:
    return mart["agg_revenue_minute"].where(F.col("revenue_type") == revenue_type)


@kpi
def kpi_airtime_revenue(mart: Mart, window: Window) -> DataFrame:
    return _per_minute(_revenue_of(mart, "AIRTIME"), window, {"airtime": "total_amount"})


@kpi
def kpi_bundle_revenue(mart: Mart, window: Window) -> DataFrame:
    return _per_minute(_revenue_of(mart, "BUNDLE"), window, {"bundles": "total_amount"})


@kpi
def kpi_top_bundles(mart: Mart, window: Window) -> DataFrame:
    """Sales are counted per key first, so a hot bundle is one row before the join."""
    by_key = (
        window.tile(mart["fact_bundle_sales"], "event_timestamp")
        .groupBy("bundle_key")
        .agg(F.count("*").alias("n"))
    )
    return (
        by_key.join(mart["dim_bundle"].select("bundle_key", "bundle_name"), "bundle_key")
        .groupBy(F.col("bundle_name").alias("bundle"))
        .agg(F.sum("n").alias("sales"))
        .orderBy(F.desc("sales"), "bundle")
        .limit(8)
    )


@kpi
def kpi_revenue_by_province(mart: Mart, window: Window) -> DataFrame:
    return (
        window.tile(mart["agg_revenue_minute"], "minute")
        .groupBy("province")
        .agg(F.sum("total_amount").alias("revenue"))
        .orderBy(F.desc("revenue"), "province")
    )


@kpi
def kpi_avg_recharge(mart: Mart, window: Window) -> DataFrame:
    recent = window.tile(mart["fact_recharges"], "event_timestamp")
    return recent.agg(F.coalesce(F.avg("amount"), F.lit(0)).alias("avg_amount"))


@kpi
def kpi_recharges_by_method(mart: Mart, window: Window) -> DataFrame:
    return (
        window.tile(mart["fact_recharges"], "event_timestamp")
        .groupBy("payment_method")
        .agg(F.count("*").alias("recharges"))
    )


@kpi
def kpi_failed_payments(mart: Mart, window: Window) -> DataFrame:
    declined = mart["dlq_records"].where(F.col("rejection_reason") == "PAYMENT_DECLINED")
    return window.tile(declined, "rejected_at").agg(F.count("*").alias("failed"))


# --- Customers -------------------------------------------------------------------------------


@kpi
def kpi_subs_by_province(mart: Mart, window: Window) -> DataFrame:
    return (
        mart["dim_subscriber"]
        .groupBy("province")
        .agg(F.count("*").alias("subscribers"))
        .orderBy(F.desc("subscribers"), "province")
    )


@kpi
def kpi_subs_by_plan(mart: Mart, window: Window) -> DataFrame:
    return mart["dim_subscriber"].groupBy("plan").agg(F.count("*").alias("subscribers"))


@kpi
def kpi_arpu(mart: Mart, window: Window) -> DataFrame:
    """Revenue of the last 24 hours per subscriber of the whole base: two one-row aggregates."""
    day = times.since(mart["agg_revenue_minute"], "minute", window.clock, 24)
    revenue = _total(day, "total_amount", "revenue")
    base = mart["dim_subscriber"].agg(F.count_distinct("subscriber_key").alias("subscribers"))
    return revenue.join(base, F.lit(True)).select(
        (F.col("revenue") / F.greatest("subscribers", F.lit(1))).alias("arpu")
    )


@kpi
def kpi_top_data_users(mart: Mart, window: Window) -> DataFrame:
    """Volume is summed per subscriber first, so a hot subscriber is one row before the join."""
    usage = (
        window.tile(mart["fact_data_usage"], "event_timestamp")
        .groupBy("subscriber_key")
        .agg(F.sum("mb_used").alias("mb"))
    )
    who = mart["dim_subscriber"].select("subscriber_key", "msisdn", "province")
    return (
        usage.join(who, "subscriber_key")
        .groupBy("msisdn", "province")
        .agg(F.round(F.sum("mb"), 1).alias("mb_used"))
        .orderBy(F.desc("mb_used"), "msisdn")
        .limit(10)
    )


# --- Pipeline --------------------------------------------------------------------------------


@kpi
def kpi_rejections_by_reason(mart: Mart, window: Window) -> DataFrame:
    metric = F.col("rejection_reason").alias("metric")
    return _per_minute(mart["agg_dlq_minute"], window, {"value": "record_count"}, metric)


@kpi
def kpi_latest_dlq(mart: Mart, window: Window) -> DataFrame:
    """The newest are found by two narrow columns; texts are fetched for these alone, from their days."""
    records = mart["dlq_records"]
    order = [F.desc("rejected_at"), F.col("event_id")]
    newest = records.select("rejected_at", "event_id", "date_key").orderBy(*order).limit(25)
    return (
        records.join(newest.select("event_id", "date_key"), ["event_id", "date_key"], "left_semi")
        .orderBy(*order)
        .limit(25)
        .select(
            F.col("rejected_at").alias("rejected"),
            F.col("source_topic").alias("topic"),
            F.col("rejection_reason").alias("reason"),
            F.left("original_payload", F.lit(120)).alias("payload"),
        )
    )


@kpi
def kpi_tps(mart: Mart, window: Window) -> DataFrame:
    """Transactions per second: facts of all five tables per minute over sixty."""
    counts = None
    for name in (
        "fact_recharges", "fact_bundle_sales", "fact_calls", "fact_sms", "fact_data_usage"
    ):
        stamps = window.series(mart[name], "event_timestamp").select("event_timestamp")
        counts = stamps if counts is None else counts.unionByName(stamps)
    return (
        counts.groupBy(times.minute_of("event_timestamp").alias("time"))
        .agg((F.count("*") / 60.0).alias("tps"))
        .orderBy("time")
    )
