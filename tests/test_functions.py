"""Expressions checked against Python's own implementations."""

import uuid
from datetime import UTC, datetime

from pyspark.sql import functions as F

from signalmart import catalog
from signalmart.functions import ids, times

STAMPS = [
    "2026-07-14T08:30:00+02:00", "2026-07-14T08:30:00Z", "2026-07-14 08:30:00.123456",
    "2026-07-14T08:30:00,5+0200", "2026-07-14T08:30", "2026-07-14T08:30Z", "2026-07-14T08:30-05:30",
    "2026-07-14", "2026", "2026-07", "2026-7-4", "T08:30:00", "08:30", "", "nonsense",
    "2026-02-30", "2026-07-14T25:00:00", "2026-07-14T08:30:00 x", "2026-07-14T08:30:00\n",
    "2026-07-14T08:30:00.1234567Z",
    # Basic forms, hours alone, any separator, offsets of any precision and size.
    "20260714", "20260714T083000Z", "20260714T0830", "2026-07-14T08", "20260714x08:30:00.5-0330", "2026-07-14t08:30",
    "2026-07-14🙂08:30", "2026-07-14-08:30", "2026-07-1408:30", "2026-07-14T08:30:00+05:30:15", "2026-07-14T08+23:59:59.999999",
    "2026-07-14T08:30:00+24:00", "2026-07-14T08:30:00+01:99", "2026-07-14T08:30:00-183000", "2026-07-14T083000,123456789Z",
    "2026-07-14T08:30:00Z1", "2026-07-14T08:30:00+", "2026-07-14T08:30:00+1", "2026-07-14T08:30:00+001", "2026-07-14T0830:00",
    "2026-07-14T08:3000", "2026-07-14T08:60", "2026-07-14T24:00", "2026-07-14T08:30:60", "2026-07-14T8:30", "2026-07-14T08:30:00.",
    "2026-07-14T08.5", "2026-07-14T08:30.5", "2026-07-14T", "20260714T", "0000-01-01", "0001-01-01", "9999-12-31T23:59:59.999999",
    "2024-02-29", "2023-02-29", "20240229T01", "2026-13-01", "2026-00-10", "2026-07-00", "2026-07-14T08:30:00z",
    # A stray character before the offset.
    "2026-07-14T08:30:00 +02:00", "2026-07-14T08:30xZ", "2026-07-14T08x-01", "2026-07-14T08:30:00.5x+01:00", "2026-07-14T08:30:00x",
    "2026-07-14T08:30:00é+01:00", "2026-07-14T08:30:00.+01:00", "2026-07-14T100+01:00",
    # Week dates.
    "2026-W29", "2026W29", "2026-W29-2", "2026W292", "2026-W29-2T08:30", "2026W292T0830Z", "2026-W29T08", "2026W29T08:30",
    "2026-W00", "2026-W53-7", "2025-W53", "2020-W53-1", "2026-W54-1", "2026-W29-0", "2026-W29-8", "2026-W01-1", "2026W29-2",
    "2026-W292", "2026-W29-", "2026-W29-10:00", "2026-W29-1010", "2026W2951000", "2026W2912", "2026W29123", "0001-W01-1", "2026-W2",
    "1969-12-31T23:59:59.5", "2026-07-14\n08:30", "2026-07-14T08:30:00\r\n", "²026-07-14", "2026-07-14T0٣:30", "        ", "2026-W-29",
]
STAMPS += [
    date + time + zone
    for date in ("2026-07-14", "20260714", "2026-W29-2", "2026W292", "2026W29", "2026-W29", "2026-071", "2026071")
    for time in ("T08", "T0830", "T08:30", " 08:30:15", "_083015.25", "508:30", "T08:30:1", "T08:301", "-083015")
    for zone in ("", "Z", "+02", "-0230", "+02:30:15", "+02:3015", "+02:30:15.000001", "+")
]


def reference_instant(text):
    try:
        stamp = datetime.fromisoformat(text)
    except ValueError:
        return None
    return (stamp if stamp.tzinfo else stamp.replace(tzinfo=UTC)).astimezone(UTC).replace(tzinfo=None)


def test_iso_timestamp_is_what_python_reads(spark):
    df = spark.createDataFrame([(s,) for s in STAMPS], "s string")
    out = df.select("s", times.iso_timestamp(F.col("s")).cast("timestamp_ntz").alias("t"))
    assert {r["s"]: r["t"] for r in out.collect()} == {s: reference_instant(s) for s in STAMPS}


def test_iso_timestamp_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Africa/Johannesburg")
    try:
        df = spark.createDataFrame([("2026-07-14T08:30:00",)], "s string")
        micros = df.select(F.unix_micros(times.iso_timestamp(F.col("s")))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == int(datetime(2026, 7, 14, 8, 30, tzinfo=UTC).timestamp() * 1e6)


def test_uuid5_matches_the_standard_library(spark):
    names = ["", "sms|PARSE_ERROR|{", "日本|x|ü", "a" * 5000]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = df.select("n", ids.uuid5(catalog.DLQ_NAMESPACE, F.col("n")).alias("u")).collect()
    namespace = uuid.UUID(catalog.DLQ_NAMESPACE)
    assert {r["n"]: r["u"] for r in out} == {n: str(uuid.uuid5(namespace, n)) for n in names}


def test_time_filter_bounds(spark):
    df = spark.sql(
        "select timestamp'2026-01-01 00:00:00' + make_dt_interval(0, 0, id) as t from range(4) t(id)"
    )
    at = F.lit(datetime(2026, 1, 1, 0, 2, tzinfo=UTC))
    lo = F.lit(datetime(2026, 1, 1, 0, 1, tzinfo=UTC))
    assert times.between(df, "t", lo, at).count() == 2  # both ends included
    hour_later = F.lit(datetime(2026, 1, 1, 1, 1, tzinfo=UTC))
    assert times.since(df, "t", hour_later, 1).count() == 2  # strictly younger


def test_calendar(spark):
    days = catalog.calendar_between(spark, "2026-01-01", "2027-12-31")
    assert days.count() == 730 and days.where("is_weekend").count() == 208
    first = days.where("date_key = 20260101").first()
    assert (first["day_of_week"], first["quarter"], first["is_weekend"]) == (4, 1, False)


def test_seeds(spark):
    assert catalog.tower_seed(spark).count() == 18
    assert catalog.bundle_seed(spark).where("price = 99.00").first()["bundle_code"] == "DATA_1GB"
