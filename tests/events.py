"""Hand-made wire events for the tests."""

from __future__ import annotations

import json
import uuid

NOW = "2026-07-17T12:00:00+00:00"

BODIES = {
    "subscriber-created": ("subscriber_created", {
        "subscriber_id": 1, "msisdn": "27821234567", "plan": "Prepaid", "province": "Gauteng"}),
    "airtime-purchases": ("airtime_purchase", {
        "subscriber_id": 1, "amount": 50.0, "payment_method": "Card"}),
    "bundle-purchases": ("bundle_purchase", {
        "subscriber_id": 1, "bundle_code": "DATA_1GB", "price": 99.0}),
    "voice-calls": ("voice_call", {
        "caller_id": 1, "receiver_msisdn": "27821234567", "duration_seconds": 60,
        "tower_id": "CPT-CBD-001", "dropped": False}),
    "sms": ("sms", {"sender_id": 1, "receiver_msisdn": "27821234567", "length": 20}),
    "data-usage": ("data_usage", {
        "subscriber_id": 1, "mb_used": 12.5, "session_seconds": 30, "tower_id": "CPT-CBD-001",
        "technology": "LTE"}),
    "tower-events": ("tower_status", {
        "tower_id": "CPT-CBD-001", "technology": "LTE", "signal_strength": 80,
        "connected_devices": 5, "status": "HEALTHY"}),
}


def event(topic: str, seed: str = "a", **changes) -> dict:
    kind, body = BODIES[topic]
    out = {
        "event_id": str(uuid.uuid5(uuid.NAMESPACE_OID, f"{topic}/{seed}")),
        "event_type": kind,
        "timestamp": "2026-07-17T10:00:00+00:00",
        "schema_version": 1,
        **body,
    }
    out.update(changes)
    return {name: value for name, value in out.items() if value is not ...}


def raw_frame(spark, records):
    """Records `(topic, event or text)`; the offset is the position."""
    rows = [
        (topic, 0, position, body if body is None or isinstance(body, str) else json.dumps(body))
        for position, (topic, body) in enumerate(records)
    ]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, raw string")
