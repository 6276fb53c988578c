"""Dead letters: envelope, deterministic identity, publishing form, intake."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart import catalog
from signalmart.functions import ids, strict_json, times
from signalmart.operators import keys, validate

RECORD_TYPE = "dlq_record"
UNKNOWN_SUBSCRIBER = "REFERENTIAL:subscriber_unknown"
DUPLICATE_MSISDN = "REFERENTIAL:msisdn_duplicate"


def record_id(topic: Column, reason: Column, payload: Column) -> Column:
    """Same reject, same id: replays collide instead of piling up."""
    return ids.uuid5(catalog.DLQ_NAMESPACE, F.concat_ws("|", topic, reason, payload))


def envelope(rejects: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Rejects `(topic, partition, offset, raw, reason)` as dead-letter records.

    A record without any text keeps an empty payload.
    """
    payload = F.coalesce("raw", F.lit(""))
    return rejects.select(
        record_id(F.col("topic"), F.col("reason"), payload).alias("event_id"),
        F.lit(RECORD_TYPE).alias("event_type"),
        times.iso_millis(times.as_time(as_of)).alias("timestamp"),
        F.lit(1).cast("bigint").alias("schema_version"),
        F.col("topic").alias("source_topic"),
        F.col("reason").alias("rejection_reason"),
        payload.alias("original_payload"),
        "partition",
        "offset",
    )


def to_broker(records: DataFrame) -> DataFrame:
    """Envelopes as compact JSON in broker shape, with their origin kept for ordering."""
    columns = [name for name, _ in catalog.fields(RECORD_TYPE)]
    return records.select(
        F.lit(catalog.DLQ_TOPIC).alias("topic"),
        "partition",
        "offset",
        F.to_json(F.struct(*columns)).alias("value"),
    )


def intake(raw: DataFrame) -> DataFrame:
    """Dead-letter messages with `skipped` and its `cause`: malformed ones are flagged, not lost."""
    typed = validate.parsed(raw.withColumn("event_type", F.lit(RECORD_TYPE)), (RECORD_TYPE,))
    tag = strict_json.first_schema_tag((RECORD_TYPE,), strict=False)
    cause = (
        F.when(F.col("document").isNull(), "PARSE_ERROR")
        .when(tag.isNotNull(), tag)
        .when(F.col("event_timestamp").isNull(), "format:timestamp")
    )
    judged = strict_json.fixed(typed, "cause", cause).drop("document")
    return judged.withColumn("skipped", F.col("cause").isNotNull())


def skipped(taken: DataFrame) -> DataFrame:
    """Messages `intake` could not use, with their text, for review."""
    return taken.where("skipped").select("topic", "partition", "offset", "raw", "cause")


def records(taken: DataFrame) -> DataFrame:
    """Table rows of the usable messages, one per id."""
    usable = taken.where(~F.col("skipped"))
    return keys.first_per_key(usable, ["event_id"], keys.arrival_order()).select(
        "event_id",
        "source_topic",
        "rejection_reason",
        "original_payload",
        F.col("event_timestamp").alias("rejected_at"),
        times.date_key_of("event_timestamp").alias("date_key"),
    )


def declined_payments(dlq_records: DataFrame) -> DataFrame:
    """Airtime purchases wrapped in payment-failure records, unpacked."""
    purchase = F.from_json("original_payload", catalog.struct_type("airtime_purchase"))
    return (
        dlq_records.where(F.col("rejection_reason") == "PAYMENT_DECLINED")
        .withColumn("purchase", purchase)
        .select(
            F.col("event_id").alias("dlq_id"),
            "rejected_at",
            F.col("purchase.event_id").alias("event_id"),
            F.col("purchase.subscriber_id").alias("subscriber_id"),
            F.col("purchase.amount").alias("amount"),
            F.col("purchase.payment_method").alias("payment_method"),
        )
    )
