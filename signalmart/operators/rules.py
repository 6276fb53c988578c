"""Business rules as data: a name and a boolean expression over the typed payload columns.

A rule that evaluates to NULL counts as violated. Users extend the engine by adding `Rule`s to a
copy of `RULES`; they write Catalyst expressions, never row functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import catalog
from signalmart.functions import times


@dataclass(frozen=True)
class Rule:
    name: str
    accepts: Callable[[Column], Column]  # receives the batch clock


@dataclass(frozen=True)
class Reference:
    """Lookup tables the rules compare against; each has one row per code."""

    towers: DataFrame  # tower_id
    bundles: DataFrame  # bundle_code, price

    @classmethod
    def seeded(cls, spark: SparkSession) -> Reference:
        return cls(catalog.tower_seed(spark), catalog.bundle_seed(spark))


def _c(name: str) -> Column:
    return F.col(name)


def _not_in_future(as_of: Column) -> Column:
    return _c("event_timestamp") <= as_of + F.make_dt_interval(secs=F.lit(catalog.CLOCK_SKEW_SECONDS))


def _msisdn(column: str) -> Callable[[Column], Column]:
    return lambda _: _c(column).rlike(catalog.MSISDN_PATTERN)


def _one_of(column: str, values: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda _: _c(column).isin(*values)


TIMESTAMP_RULE = Rule("timestamp_not_in_future", _not_in_future)
TOWER_RULE = Rule("tower_exists", lambda _: _c("tower_known"))

RULES: dict[str, tuple[Rule, ...]] = {
    "subscriber_created": (
        TIMESTAMP_RULE,
        Rule("msisdn_format", _msisdn("msisdn")),
        Rule("plan_known", _one_of("plan", catalog.PLANS)),
        Rule("province_known", _one_of("province", catalog.PROVINCES)),
    ),
    "airtime_purchase": (
        TIMESTAMP_RULE,
        Rule("amount_positive", lambda _: _c("amount") > 0),
        Rule("amount_within_limit", lambda _: _c("amount") <= catalog.MAX_RECHARGE),
        Rule("payment_method_known", _one_of("payment_method", catalog.PAYMENT_METHODS)),
    ),
    "bundle_purchase": (
        TIMESTAMP_RULE,
        Rule("bundle_exists", lambda _: _c("catalog_price").isNotNull()),
        Rule("price_matches_catalog", lambda _: _c("price") == _c("catalog_price")),
    ),
    "voice_call": (
        TIMESTAMP_RULE,
        Rule("duration_not_negative", lambda _: _c("duration_seconds") >= 0),
        Rule("duration_within_limit", lambda _: _c("duration_seconds") <= catalog.MAX_CALL_SECONDS),
        TOWER_RULE,
        Rule("receiver_msisdn_format", _msisdn("receiver_msisdn")),
    ),
    "sms": (
        TIMESTAMP_RULE,
        Rule("length_positive", lambda _: _c("length") >= 1),
        Rule("length_within_limit", lambda _: _c("length") <= catalog.MAX_SMS_LENGTH),
        Rule("receiver_msisdn_format", _msisdn("receiver_msisdn")),
    ),
    "data_usage": (
        TIMESTAMP_RULE,
        Rule("volume_positive", lambda _: _c("mb_used") > 0),
        Rule("volume_within_limit", lambda _: _c("mb_used") <= catalog.MAX_SESSION_MB),
        Rule("session_positive", lambda _: _c("session_seconds") > 0),
        TOWER_RULE,
        Rule("technology_known", _one_of("technology", catalog.TECHNOLOGIES)),
    ),
    "tower_status": (
        TIMESTAMP_RULE,
        Rule("signal_in_range", lambda _: _c("signal_strength").between(0, 100)),
        Rule("devices_not_negative", lambda _: _c("connected_devices") >= 0),
        TOWER_RULE,
        Rule("status_known", _one_of("status", catalog.TOWER_STATUSES)),
    ),
}


def _hits(rules: tuple[Rule, ...], as_of: Column) -> list[Column]:
    return [F.when(~F.coalesce(rule.accepts(as_of), F.lit(False)), rule.name) for rule in rules]


def violated(rules: tuple[Rule, ...], as_of: Column) -> Column:
    """Names of all violated rules in rule order."""
    return F.array_compact(F.array(*_hits(rules, as_of)))


def first_violated(rules: tuple[Rule, ...], as_of: Column) -> Column:
    return F.coalesce(*_hits(rules, as_of))


def spread_null(key: str, salt: Column) -> Column:
    """Join key whose NULLs are scattered over codes nothing matches.

    Most rows of a mixed batch lack any one code; unspread, they would all hash to one task.
    """
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), salt.cast("string")))


def with_reference(df: DataFrame, reference: Reference) -> DataFrame:
    """Add `tower_known` and `catalog_price`.

    No broadcast hint: the seeds are broadcast because they are measured to be small, a large
    catalogue takes the shuffled join with its hot codes split at run time.
    """
    towers = reference.towers.select(
        F.col("tower_id").alias("_tower"), F.lit(True).alias("tower_known")
    )
    bundles = reference.bundles.select(
        F.col("bundle_code").alias("_bundle"), F.col("price").cast("double").alias("catalog_price")
    )
    salt = F.xxhash64("event_id", "partition", "offset")  # also apart where there is no id
    return (
        df.join(towers, spread_null("tower_id", salt) == F.col("_tower"), "left")
        .join(bundles, spread_null("bundle_code", salt) == F.col("_bundle"), "left")
        .withColumn("tower_known", F.coalesce("tower_known", F.lit(False)))
        .drop("_tower", "_bundle")
    )
