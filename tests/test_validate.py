"""Verdicts on hand-made records: structure, rules, strictness, order of reasons."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from signalmart import catalog
from signalmart.functions import strict_json
from signalmart.operators import rules, validate
from signalmart.operators.rules import Reference
from tests.events import BODIES, event, raw_frame

AS_OF = datetime(2026, 7, 17, 12, tzinfo=UTC)
AIR = "airtime-purchases"


def text(topic=AIR, **changes):
    import json

    return json.dumps(event(topic, **changes))


STRUCTURE = {
    "valid": (text(), []),
    "spaces around": (f"  {text()}\n", []),
    "missing": (text(amount=...), ["missing:amount"]),
    "wrong type": (text(amount="fifty"), ["type:amount"]),
    "integer for float": (text(amount=50), []),
    "exponent for float": (text().replace("50.0", "5e1"), []),
    "bool for float": (text(amount=True), ["type:amount"]),
    "bool for int": (text(subscriber_id=True), ["type:subscriber_id"]),
    "float for int": (text(subscriber_id=1.0), ["type:subscriber_id"]),
    "beyond 64 bit": (text(subscriber_id=2**64), ["type:subscriber_id"]),
    "null": (text(amount=None), ["type:amount"]),
    "number for text": (text(payment_method=3), ["type:payment_method"]),
    "nested for text": (text(payment_method={"amount": 1}), ["type:payment_method"]),
    "unexpected": (text(discount=10), ["unexpected:discount"]),
    "two unexpected": (text(zeta=1, alpha=2), ["unexpected:zeta", "unexpected:alpha"]),
    "schema look-alike key": (
        text(amount=...).replace("}", ', "amount: BIGINT, event_id": 1}'),
        ["missing:amount", "unexpected:amount: BIGINT, event_id"],
    ),
    "case differs": (text(amount=..., Amount=1.0), ["missing:amount", "unexpected:Amount"]),
    "order of tags": (
        text(event_id=..., amount="x", extra=1),
        ["missing:event_id", "type:amount", "unexpected:extra"],
    ),
    "repeated key keeps the last": (text().replace('"amount"', '"amount": "x", "amount"'), []),
    "array": ("[1,2]", ["not_an_object"]),
    "json null": ("null", ["not_an_object"]),
    "number": ("7", ["not_an_object"]),
    "no text": (None, None),
    "empty": ("", None),
    "truncated": (text()[:-1], None),
    "trailing garbage": (text() + " x", None),
    "two documents": (text() + "," + text(), None),
    "two documents, newline": (text() + "\n" + text(), None),
    "closes the box": (text() + "] x", None),
    "closes the box, object": (text() + "]} x", None),
    "not a number": (text().replace("50.0", "NaN"), None),
}


def test_structural_tags(spark):
    raw = raw_frame(spark, [(AIR, body) for body, _ in STRUCTURE.values()])
    rows = validate.schema_violations_of(raw, strict=False).orderBy("offset").collect()
    got = dict(zip(STRUCTURE, [row["violations"] for row in rows]))
    assert got == {name: tags for name, (_, tags) in STRUCTURE.items()}


def test_first_tag_is_the_first_of_all(spark):
    raw = raw_frame(spark, [(AIR, body) for body, _ in STRUCTURE.values()])
    typed = validate.parsed(validate.with_event_type(raw))
    tag = strict_json.first_schema_tag(("airtime_purchase",), strict=False)
    got = dict(zip(STRUCTURE, [r["tag"] for r in typed.select(tag.alias("tag"), "offset").orderBy("offset").collect()]))
    sound = {name: (tags or [None])[0] for name, (_, tags) in STRUCTURE.items() if tags is not None}
    assert {name: got[name] for name in sound} == sound


STRICT = {
    "not a uuid": ({"event_id": "abc"}, "SCHEMA_VIOLATION:format:event_id"),
    # Ids are told apart without regard to case, so an upper-case one is an id like any other.
    "upper case uuid": ({"event_id": "A7D0D0F0-5C6B-4C5E-9B3E-2F1C0000DEAD"}, None),
    "other type": ({"event_type": "sms"}, "SCHEMA_VIOLATION:value:event_type"),
    "version zero": ({"schema_version": 0}, "SCHEMA_VIOLATION:value:schema_version"),
}


@pytest.mark.parametrize("strict", [True, False])
def test_strict_mode(spark, strict):
    raw = raw_frame(spark, [(AIR, event(AIR, **changes)) for changes, _ in STRICT.values()])
    out = validate.validate(raw, Reference.seeded(spark), AS_OF, strict=strict)
    reasons = [row["reason"] for row in out.orderBy("offset").collect()]
    assert reasons == [reason if strict else None for _, reason in STRICT.values()]
    ids = {row["event_id"] for row in validate.accepted(out).select("event_id").collect()}
    assert "a7d0d0f0-5c6b-4c5e-9b3e-2f1c0000dead" in ids


RULE_CASES = [
    ("subscriber-created", {"msisdn": "0821234567"}, ["msisdn_format"]),
    ("subscriber-created", {"msisdn": "27821234567\n"}, ["msisdn_format"]),
    ("subscriber-created", {"plan": "Gold"}, ["plan_known"]),
    ("subscriber-created", {"province": "Atlantis"}, ["province_known"]),
    (AIR, {"amount": 0}, ["amount_positive"]),
    (AIR, {"amount": -50.0}, ["amount_positive"]),
    (AIR, {"amount": 1000.0}, []),
    (AIR, {"amount": 1000.01}, ["amount_within_limit"]),
    (AIR, {"payment_method": "Cash"}, ["payment_method_known"]),
    ("bundle-purchases", {"bundle_code": "NONE"}, ["bundle_exists", "price_matches_catalog"]),
    ("bundle-purchases", {"price": 98.0}, ["price_matches_catalog"]),
    ("bundle-purchases", {"price": 99}, []),
    ("voice-calls", {"duration_seconds": -1}, ["duration_not_negative"]),
    ("voice-calls", {"duration_seconds": 21601}, ["duration_within_limit"]),
    ("voice-calls", {"tower_id": "X"}, ["tower_exists"]),
    ("voice-calls", {"receiver_msisdn": "2782123456"}, ["receiver_msisdn_format"]),
    ("sms", {"length": 0}, ["length_positive"]),
    ("sms", {"length": 1601}, ["length_within_limit"]),
    ("sms", {"receiver_msisdn": "x"}, ["receiver_msisdn_format"]),
    ("data-usage", {"mb_used": 0.0}, ["volume_positive"]),
    ("data-usage", {"mb_used": 10240.5}, ["volume_within_limit"]),
    ("data-usage", {"session_seconds": 0}, ["session_positive"]),
    ("data-usage", {"tower_id": "X", "technology": "9G"}, ["tower_exists", "technology_known"]),
    ("tower-events", {"signal_strength": 101}, ["signal_in_range"]),
    ("tower-events", {"signal_strength": 0}, []),
    ("tower-events", {"connected_devices": -1}, ["devices_not_negative"]),
    ("tower-events", {"tower_id": "X"}, ["tower_exists"]),
    ("tower-events", {"status": "ON_FIRE"}, ["status_known"]),
    (AIR, {"timestamp": "2026-07-17T12:00:30Z"}, []),
    (AIR, {"timestamp": "2026-07-17T12:00:31Z"}, ["timestamp_not_in_future"]),
    (AIR, {"timestamp": "2026-07-17T14:00:30+02:00"}, []),
    (AIR, {"timestamp": "2026-07-17"}, []),
    (AIR, {"timestamp": "2026-07-17 11:59"}, []),
    (AIR, {"timestamp": "yesterday"}, ["timestamp_not_in_future"]),
    (AIR, {"timestamp": "2026"}, ["timestamp_not_in_future"]),
    (AIR, {"timestamp": "08:30"}, ["timestamp_not_in_future"]),
    *[(topic, {}, []) for topic in BODIES],
]


def test_rules(spark):
    raw = raw_frame(spark, [(topic, event(topic, **changes)) for topic, changes, _ in RULE_CASES])
    checked = validate.rule_violations_of(raw, Reference.seeded(spark), AS_OF).orderBy("offset")
    got = [row["violations"] for row in checked.collect()]
    assert [(t, c, g) for (t, c, _), g in zip(RULE_CASES, got)] == RULE_CASES
    verdicts = validate.validate(raw, Reference.seeded(spark), AS_OF).orderBy("offset").collect()
    assert [row["reason"] for row in verdicts] == [
        f"RULE_VIOLATION:{names[0]}" if names else None for _, _, names in RULE_CASES
    ]


def test_missing_fields_violate_rules(spark):
    raw = raw_frame(spark, [(AIR, '{"event_type": "airtime_purchase"}')])
    names = validate.rule_violations_of(raw, Reference.seeded(spark), AS_OF).first()["violations"]
    assert {"amount_positive", "timestamp_not_in_future"} <= set(names)


def test_every_type_has_rules_and_reasons_are_whole(spark):
    assert set(rules.RULES) == set(catalog.EVENT_TYPES)
    raw = raw_frame(spark, [(AIR, event(AIR, **{"k" * 300: 1}))])
    reason = validate.validate(raw, Reference.seeded(spark), AS_OF).first()["reason"]
    assert len(reason) > 128 and reason.startswith("SCHEMA_VIOLATION:unexpected:kkk")


def test_unknown_topics_are_left_out(spark):
    raw = raw_frame(spark, [("other-topic", event(AIR)), (AIR, event(AIR))])
    assert validate.validate(raw, Reference.seeded(spark), AS_OF).count() == 1


def test_large_reference_takes_no_broadcast_and_agrees(spark):
    raw = raw_frame(spark, [(topic, event(topic, **changes)) for topic, changes, _ in RULE_CASES])
    want = validate.validate(raw, Reference.seeded(spark), AS_OF).select("offset", "reason")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = validate.validate(raw, Reference.seeded(spark), AS_OF).select("offset", "reason")
        got = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(map(tuple, want.collect()))


def test_custom_rule(spark):
    extra = {**rules.RULES, "sms": (*rules.RULES["sms"], rules.Rule("short", lambda _: F.col("length") < 10))}
    raw = raw_frame(spark, [("sms", event("sms"))])
    reason = validate.validate(raw, Reference.seeded(spark), AS_OF, rules=extra).first()["reason"]
    assert reason == "RULE_VIOLATION:short"


def test_typed_values_of_accepted_events(spark):
    bodies = {
        "repeated key": (text().replace('"amount"', '"amount": "x", "amount"'), 50.0),
        "repeated key, other order": (text().replace("50.0", '7, "amount": 50.0'), 50.0),
        "integer": (text(amount=50), 50.0),
        "exponent": (text().replace("50.0", "5e1"), 50.0),
        "many digits": (text().replace("50.0", "50.000000000000000000000000000000000000000000001"), 50.0),
    }
    raw = raw_frame(spark, [(AIR, body) for body, _ in bodies.values()])
    out = validate.accepted(validate.validate(raw, Reference.seeded(spark), AS_OF)).orderBy("offset")
    got = [row["amount"] for row in out.collect()]
    assert dict(zip(bodies, got, strict=True)) == {name: value for name, (_, value) in bodies.items()}
