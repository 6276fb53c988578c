"""Event contracts and reference data: the one place every schema, rule bound and seed comes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: wire contracts ------------------------------------------------------------

ENVELOPE = "event_id string, event_type string, timestamp string, schema_version bigint"

PAYLOADS = {
    "subscriber_created": "subscriber_id bigint, msisdn string, plan string, province string",
    "airtime_purchase": "subscriber_id bigint, amount double, payment_method string",
    "bundle_purchase": "subscriber_id bigint, bundle_code string, price double",
    "voice_call": "caller_id bigint, receiver_msisdn string, duration_seconds bigint,"
    " tower_id string, dropped boolean",
    "sms": "sender_id bigint, receiver_msisdn string, length bigint",
    "data_usage": "subscriber_id bigint, mb_used double, session_seconds bigint,"
    " tower_id string, technology string",
    "tower_status": "tower_id string, technology string, signal_strength bigint,"
    " connected_devices bigint, status string",
    "dlq_record": "source_topic string, rejection_reason string, original_payload string",
}

TOPICS = {
    "subscriber-created": "subscriber_created",
    "airtime-purchases": "airtime_purchase",
    "bundle-purchases": "bundle_purchase",
    "voice-calls": "voice_call",
    "sms": "sms",
    "data-usage": "data_usage",
    "tower-events": "tower_status",
}
DLQ_TOPIC = "failed-transactions"
DLQ_NAMESPACE = "a7d0d0f0-5c6b-4c5e-9b3e-2f1c0000dead"

# --- Fixed values: enumerations and limits ---------------------------------------------------

PROVINCES = (
    "Eastern Cape",
    "Free State",
    "Gauteng",
    "KwaZulu-Natal",
    "Limpopo",
    "Mpumalanga",
    "Northern Cape",
    "North West",
    "Western Cape",
)
PLANS = ("Prepaid", "Contract", "TopUp")
PAYMENT_METHODS = ("Voucher", "Card", "EFT", "USSD")
TECHNOLOGIES = ("3G", "LTE", "5G")
TOWER_STATUSES = ("HEALTHY", "DEGRADED", "DOWN")

MAX_CALL_SECONDS = 21600
MAX_SESSION_MB = 10240.0
MAX_RECHARGE = 1000.0
MAX_SMS_LENGTH = 1600
CLOCK_SKEW_SECONDS = 30

# \z, not $: a dollar would also admit a trailing newline.
MSISDN_PATTERN = r"^27[0-9]{9}\z"
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"

# --- Fixed values: dimension seeds -----------------------------------------------------------

TOWERS = (
    # tower_id, tower_name, province, technologies
    ("CPT-CBD-001", "Cape Town CBD", "Western Cape", ("3G", "LTE", "5G")),
    ("CPT-BLV-003", "Bellville", "Western Cape", ("3G", "LTE")),
    ("CPT-CC-002", "Century City", "Western Cape", ("LTE", "5G")),
    ("CPT-STB-004", "Stellenbosch", "Western Cape", ("3G", "LTE")),
    ("JHB-SDT-001", "Sandton", "Gauteng", ("LTE", "5G")),
    ("JHB-CBD-002", "Johannesburg CBD", "Gauteng", ("3G", "LTE", "5G")),
    ("JHB-SWT-003", "Soweto", "Gauteng", ("3G", "LTE")),
    ("PTA-CBD-001", "Pretoria CBD", "Gauteng", ("3G", "LTE", "5G")),
    ("DBN-CBD-001", "Durban CBD", "KwaZulu-Natal", ("3G", "LTE", "5G")),
    ("DBN-UMH-002", "Umhlanga", "KwaZulu-Natal", ("LTE", "5G")),
    ("PMB-CBD-001", "Pietermaritzburg", "KwaZulu-Natal", ("3G", "LTE")),
    ("GQB-CBD-001", "Gqeberha Central", "Eastern Cape", ("3G", "LTE")),
    ("EL-CBD-001", "East London", "Eastern Cape", ("3G", "LTE")),
    ("BFN-CBD-001", "Bloemfontein", "Free State", ("3G", "LTE")),
    ("PLK-CBD-001", "Polokwane", "Limpopo", ("3G", "LTE")),
    ("NLP-CBD-001", "Mbombela", "Mpumalanga", ("3G", "LTE")),
    ("KIM-CBD-001", "Kimberley", "Northern Cape", ("3G",)),
    ("RTB-CBD-001", "Rustenburg", "North West", ("3G", "LTE")),
)
BUNDLES = (
    # bundle_code, bundle_name, bundle_type, price
    ("DATA_1GB", "1GB Data", "DATA", "99.00"),
    ("DATA_5GB", "5GB Data", "DATA", "199.00"),
    ("DATA_20GB", "20GB Data", "DATA", "399.00"),
    ("VOICE_100MIN", "100 Minutes", "VOICE", "79.00"),
    ("VOICE_300MIN", "300 Minutes", "VOICE", "169.00"),
    ("SMS_500", "500 SMS", "SMS", "49.00"),
    ("COMBO_STARTER", "Starter Combo", "COMBO", "149.00"),
    ("COMBO_POWER", "Power Combo", "COMBO", "299.00"),
)

# --- Schemas derived from the contracts above ------------------------------------------------

_SPARK_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}

EVENT_TYPES = tuple(TOPICS.values())

# The payload's own event_type is kept apart from the type its topic implies.
DECLARED_TYPE = "declared_type"


def fields(event_type: str) -> list[tuple[str, str]]:
    """(name, kind) of every field of an event type, envelope first, in contract order."""
    return [
        tuple(item.split())
        for part in (ENVELOPE, PAYLOADS[event_type])
        for item in part.split(",")
    ]


def struct_type(event_type: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _SPARK_TYPES[kind], False) for name, kind in fields(event_type)]
    )


def wide_fields(event_types: tuple[str, ...] = EVENT_TYPES) -> dict[str, str]:
    """Every field any of the event types has, once, in first-seen order."""
    return {name: kind for event_type in event_types for name, kind in fields(event_type)}


def event_type_of(topic: Column) -> Column:
    """Event type a topic carries; NULL for a topic that is not part of the contract."""
    pairs = [F.lit(part) for pair in TOPICS.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), topic)


def topic_of(event_type: Column) -> Column:
    pairs = [F.lit(part) for topic, kind in TOPICS.items() for part in (kind, topic)]
    return F.try_element_at(F.create_map(*pairs), event_type)


# --- Dimension seeds as DataFrames -----------------------------------------------------------


def tower_seed(spark: SparkSession) -> DataFrame:
    rows = [(key, *row) for key, row in enumerate(TOWERS, 1)]
    schema = "tower_key bigint, tower_id string, tower_name string, province string, technologies array<string>"
    return spark.createDataFrame(rows, schema)


def bundle_seed(spark: SparkSession) -> DataFrame:
    rows = [(key, *row) for key, row in enumerate(BUNDLES, 1)]
    raw = "bundle_key bigint, bundle_code string, bundle_name string, bundle_type string, price string"
    return spark.createDataFrame(rows, raw).withColumn("price", F.col("price").cast("decimal(10,2)"))


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between the `first_day` and `last_day` of a one-row frame, both included."""
    day = F.col("full_date")
    iso_dow = (F.weekday(day) + 1).cast("smallint")
    return bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date")
    ).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        iso_dow.alias("day_of_week"),
        F.month(day).cast("smallint").alias("month"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.year(day).cast("smallint").alias("year"),
        iso_dow.isin(6, 7).alias("is_weekend"),
    )


def calendar_between(spark: SparkSession, first_day: str, last_day: str) -> DataFrame:
    return calendar(
        spark.range(1).select(
            F.lit(first_day).cast("date").alias("first_day"),
            F.lit(last_day).cast("date").alias("last_day"),
        )
    )
