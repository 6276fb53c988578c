"""Star schema: fact builders, subscriber dimension, latest tower state."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart.functions import times
from signalmart.operators import deadletter, keys
from signalmart.sources.mart import Mart


@dataclass(frozen=True)
class FactSpec:
    """How one event type becomes one fact table."""

    table: str
    subject: str  # payload column that names the subscriber
    subject_key: str  # fact column that holds the surrogate key
    measures: dict[str, str]  # stored column -> stored type
    dims: dict[str, str] = field(default_factory=dict)  # dimension table -> its natural key


FACTS = {
    "airtime_purchase": FactSpec(
        "fact_recharges",
        "subscriber_id",
        "subscriber_key",
        {"amount": "decimal(10,2)", "payment_method": "string"},
    ),
    "bundle_purchase": FactSpec(
        "fact_bundle_sales",
        "subscriber_id",
        "subscriber_key",
        {"price": "decimal(10,2)"},
        {"dim_bundle": "bundle_code"},
    ),
    "voice_call": FactSpec(
        "fact_calls",
        "caller_id",
        "caller_key",
        {"receiver_msisdn": "string", "duration_seconds": "bigint", "dropped": "boolean"},
        {"dim_tower": "tower_id"},
    ),
    "sms": FactSpec(
        "fact_sms", "sender_id", "sender_key", {"receiver_msisdn": "string", "length": "bigint"}
    ),
    "data_usage": FactSpec(
        "fact_data_usage",
        "subscriber_id",
        "subscriber_key",
        {"mb_used": "decimal(12,2)", "session_seconds": "bigint", "technology": "string"},
        {"dim_tower": "tower_id"},
    ),
}
SURROGATES = {"dim_bundle": "bundle_key", "dim_tower": "tower_key"}
FACT_TABLES = {spec.table: spec for spec in FACTS.values()}


def subject_of(event_type: Column) -> Column:
    """The subscriber an event refers to, whatever its type calls it; NULL for tower events."""
    subject = None
    for kind, spec in FACTS.items():
        hit = event_type == kind
        value = F.col(spec.subject)
        subject = F.when(hit, value) if subject is None else subject.when(hit, value)
    return subject


def resolve_subjects(events: DataFrame, dim_subscriber: DataFrame) -> DataFrame:
    """Add `subject_id`, `subject_key` and `subject_province` (NULL when unknown) in one join.

    Rows without a subject join on a hash of their event id, so they do not pile up on one task;
    the second half of the condition keeps that hash from ever matching an id.
    """
    known = dim_subscriber.select(
        F.col("subscriber_id").alias("_known"),
        F.col("subscriber_key").alias("subject_key"),
        F.col("province").alias("subject_province"),
    )
    with_subject = events.withColumn("subject_id", subject_of(F.col("event_type")))
    spread = F.coalesce("subject_id", F.hash("event_id").cast("bigint"))
    on = (spread == F.col("_known")) & F.col("subject_id").isNotNull()
    return with_subject.join(known, on, "left").drop("_known")


def known_subscribers(events: DataFrame, dim_subscriber: DataFrame, subject: str) -> DataFrame:
    """Events whose subscriber exists."""
    ids = dim_subscriber.select(F.col("subscriber_id").alias(subject))
    return events.join(ids, subject, "left_semi")


def unknown_subscribers(resolved: DataFrame) -> DataFrame:
    """Referential rejects of resolved events, in dead-letter input shape."""
    lost = F.col("subject_id").isNotNull() & F.col("subject_key").isNull()
    return resolved.where(lost).select(
        "topic", "partition", "offset", "raw", F.lit(deadletter.UNKNOWN_SUBSCRIBER).alias("reason")
    )


def fact_rows(event_type: str, resolved: DataFrame, dims: Mart) -> DataFrame:
    """Fact rows of one event type from resolved events; dimension lookups are inner joins."""
    spec = FACTS[event_type]
    rows = resolved.where(
        (F.col("event_type") == event_type) & F.col("subject_key").isNotNull()
    )
    for dim, natural in spec.dims.items():
        rows = rows.join(dims[dim].select(natural, SURROGATES[dim]), natural, "inner")
    return rows.select(
        "event_id",
        F.col("subject_key").alias(spec.subject_key),
        *[SURROGATES[dim] for dim in spec.dims],
        "event_timestamp",
        *[F.col(name).cast(kind).alias(name) for name, kind in spec.measures.items()],
        times.date_key_of("event_timestamp").alias("date_key"),
    )


def unmatched_dims(event_type: str, resolved: DataFrame, dims: Mart) -> DataFrame:
    """Resolved events an inner dimension lookup would drop, for the audit."""
    spec = FACTS[event_type]
    rows = resolved.where((F.col("event_type") == event_type) & F.col("subject_key").isNotNull())
    missing = [
        rows.join(dims[dim].select(natural), natural, "left_anti").select(
            "event_id", F.lit(dim).alias("dimension"), F.col(natural).alias("code")
        )
        for dim, natural in spec.dims.items()
    ]
    out = missing[0]
    for part in missing[1:]:
        out = out.unionByName(part)
    return out


def new_claims(events: DataFrame, stored: DataFrame) -> DataFrame:
    """The first event of every subscriber id that is not stored; later ones are dropped silently."""
    created = events.where(F.col("event_type") == "subscriber_created")
    first = keys.first_per_key(created, ["subscriber_id"], keys.arrival_order())
    return keys.insert_if_absent(first, stored, "subscriber_id")


def winning_claims(claims: DataFrame, taken: DataFrame) -> DataFrame:
    """Dimension rows of the claims that get their number: the first of each number that is not `taken`."""
    owner = keys.first_per_key(claims, ["msisdn"], keys.arrival_order())
    return keys.insert_if_absent(owner, taken, "msisdn").select(
        F.col("subscriber_id").alias("subscriber_key"),
        "subscriber_id",
        "msisdn",
        "plan",
        "province",
        F.col("event_timestamp").alias("created_at"),
        F.lit(True).alias("is_active"),
    )


def lost_claims(claims: DataFrame, rows: DataFrame) -> DataFrame:
    """Rejects: claims of a number that went to none of `rows`, in dead-letter input shape."""
    return claims.join(rows.select("subscriber_id"), "subscriber_id", "left_anti").select(
        "topic", "partition", "offset", "raw", F.lit(deadletter.DUPLICATE_MSISDN).alias("reason")
    )


def new_subscribers(events: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dimension rows to add, events rejected for a number that is already taken).

    The first event of a subscriber id wins and stored rows are never updated; a new id that claims a taken
    number is a reject.
    """
    claims = new_claims(events, stored)
    rows = winning_claims(claims, stored)
    return rows, lost_claims(claims, rows)


def tower_state(events: DataFrame, current: DataFrame) -> DataFrame:
    """Current state after the batch: newest event per tower, a stored row wins a tie."""
    columns = ["tower_id", "technology", "signal_strength", "connected_devices", "status"]
    incoming = events.where(F.col("event_type") == "tower_status").select(
        "tower_id",
        "technology",
        "signal_strength",
        "connected_devices",
        "status",
        F.col("event_timestamp").alias("updated_at"),
        F.lit(1).alias("_source"),
        "partition",
        "offset",
    )
    stored = current.select(
        *columns,
        "updated_at",
        F.lit(0).alias("_source"),
        F.lit(0).cast("int").alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    order = [F.col("updated_at").desc(), F.col("_source").asc(), *keys.arrival_order()]
    newest = keys.latest_per_key(stored.unionByName(incoming), "tower_id", order)
    return newest.select(*columns, "updated_at")
