"""Pipeline metrics as table queries: consumer lag, ingest rate, alerts.

Input is the metrics table `(query, topic, partition, sampled_at, latest_offset, committed_offset)`,
one row per source partition and finished trigger.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart.functions import times
from signalmart.operators import keys

METRICS_SCHEMA = (
    "query string, topic string, `partition` int, sampled_at timestamp,"
    " latest_offset bigint, committed_offset bigint"
)


def latest_in_minute(metrics: DataFrame) -> DataFrame:
    """Last sample of every source partition in every minute."""
    newest = F.max(F.struct("sampled_at", "latest_offset", "committed_offset"))
    return (
        metrics.groupBy(
            "query", "topic", "partition", times.minute_of("sampled_at").alias("minute")
        )
        .agg(newest.alias("s"))
        .select("query", "topic", "partition", "minute", "s.latest_offset", "s.committed_offset")
    )


def consumer_lag(metrics: DataFrame) -> DataFrame:
    """Messages not yet consumed per query and minute."""
    return (
        latest_in_minute(metrics)
        .groupBy("query", "minute")
        .agg(F.sum(F.col("latest_offset") - F.col("committed_offset")).alias("lag"))
    )


def ingest_rate(metrics: DataFrame, buckets: tuple[str, ...] = ("minute", "day")) -> DataFrame:
    """Messages per second between consecutive samples, averaged per minute and summed by topic.

    A falling offset is a reset and counts as no progress. Samples are paired inside time buckets,
    fine to coarse, so the history of a hot partition is spread over many tasks.
    """
    paired = keys.lag_within(
        metrics,
        ["query", "topic", "partition"],
        "sampled_at",
        ["latest_offset"],
        [F.date_trunc(bucket, "sampled_at") for bucket in buckets],
    ).where(F.col("prev_sampled_at").isNotNull())
    micros = F.unix_micros("sampled_at") - F.unix_micros("prev_sampled_at")
    gained = F.greatest(F.col("latest_offset") - F.col("prev_latest_offset"), F.lit(0))
    per_partition = (
        paired.withColumns({"gained": gained, "micros": micros})
        .groupBy("topic", "query", "partition", times.minute_of("sampled_at").alias("minute"))
        .agg(F.sum("gained").alias("gained"), F.sum("micros").alias("micros"))
    )
    rate = F.when(F.col("micros") > 0, F.col("gained") * 1e6 / F.col("micros")).otherwise(0.0)
    return (
        per_partition.withColumn("rate", rate)
        .groupBy("topic", "minute")
        .agg(F.sum("gained").alias("messages"), F.sum("rate").alias("rate_per_second"))
    )


def _held(series: DataFrame, value: str, span: int, extreme: Column) -> DataFrame:
    """Per sampled minute: `held`, an extreme of recent values, and `before`, the newest value aged
    `span` to `2 * span - 1` minutes (null if there is none).

    Each sample is handed to the minutes it counts for and aggregated there: the same rows as a
    range frame, without sorting the whole series on one task. `extreme` may read `age` in minutes.
    """
    ages = F.sequence(F.lit(0), F.lit(2 * span - 1))
    old = F.when(F.col("age") >= span, F.col(value))
    return (
        series.select("minute", value, F.explode(ages).alias("age"))
        .groupBy(F.timestamp_add("MINUTE", "age", "minute").alias("minute"))
        .agg(
            extreme.alias("held"),
            F.min_by(old, F.when(F.col("age") >= span, F.col("age"))).alias("before"),
            F.min("age").alias("newest"),
        )
        .where(F.col("newest") == 0)
        .select("minute", "held", "before")
    )


def lag_alert(metrics: DataFrame, threshold: int = 50_000, span: int = 5) -> DataFrame:
    """Minutes at which the total lag has been above the threshold for `span` minutes.

    It fires once a sample at least `span` minutes old was above and none has been below since; a
    series silent for longer than the look-back of `span` minutes starts anew.
    """
    total = consumer_lag(metrics).groupBy("minute").agg(F.sum("lag").alias("lag"))
    lowest = _held(total, "lag", span, F.min(F.when(F.col("age") <= span, F.col("lag"))))
    return lowest.select(
        "minute",
        F.col("held").alias("lowest_lag"),
        ((F.col("held") > threshold) & (F.coalesce("before", F.lit(0)) > threshold)).alias("firing"),
    )


def _dense(series: DataFrame, value: str, until: Column) -> DataFrame:
    """The series with a zero for every minute without a sample, up to the minute of `until`.

    Gaps are filled from their end, between consecutive samples that are found day by day.
    """
    step = F.expr("INTERVAL 1 MINUTE")
    sampled = keys.lag_within(
        series.select("minute", value), [], "minute", [value], [F.date_trunc(b, "minute") for b in ("day", "year")]
    )
    last = series.agg(F.max("minute").alias("prev_minute")).withColumn("minute", times.minute_of(until) + step)
    gaps = (
        sampled.select("prev_minute", "minute")
        .unionByName(last)
        .where(F.col("prev_minute") + step < F.col("minute"))
        .select(F.explode(F.sequence(F.col("prev_minute") + step, F.col("minute") - step, step)).alias("minute"))
    )
    return series.select("minute", value).unionByName(gaps.withColumn(value, F.lit(0).cast("bigint")))


def stall_alert(metrics: DataFrame, as_of: datetime | Column | None = None, span: int = 5) -> DataFrame:
    """Minutes at which the rate over `span` minutes has been zero for `span` minutes.

    So nothing came in twice the span. A minute without a sample is one in which nothing came, up to the
    clock: a job that has died, or whose recorder has, fires like one that stands still.
    """
    total = ingest_rate(metrics).groupBy("minute").agg(F.sum("messages").alias("messages"))
    highest = _held(_dense(total, "messages", times.as_time(as_of)), "messages", span, F.max("messages"))
    return highest.select(
        "minute",
        F.col("held").alias("highest_messages"),
        ((F.col("held") == 0) & F.col("before").isNotNull()).alias("firing"),
    )
