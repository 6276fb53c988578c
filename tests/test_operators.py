"""Keys, star, dead letters, metrics and audits on small hand-made tables."""

import json
import random
from datetime import UTC, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from signalmart import catalog
from signalmart.operators import deadletter, keys, metrics, quality, rollups, star, validate
from signalmart.operators.rules import Reference
from signalmart.sources.mart import Mart
from signalmart.streaming import progress
from tests.events import event, raw_frame

AS_OF = datetime(2026, 7, 17, 12, tzinfo=UTC)


def accepted(spark, records):
    return validate.accepted(validate.validate(raw_frame(spark, records), Reference.seeded(spark), AS_OF))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_is_limited_before_the_exchange(spark):
    rows = [("a", 0, 3, "late"), ("a", 0, 1, "first"), ("b", 1, 0, "only"), ("a", 1, 0, "other")]
    df = spark.createDataFrame(rows, "k string, partition int, offset bigint, v string")
    out = keys.first_per_key(df, ["k"], keys.arrival_order())
    assert {(r["k"], r["v"]) for r in out.collect()} == {("a", "first"), ("b", "only")}
    text = plan(out)
    assert text.index("Exchange") < text.rindex("WindowGroupLimit"), text


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    stored = spark.createDataFrame([("b", 9), ("c", 9)], "k string, v int")
    assert [r["k"] for r in keys.insert_if_absent(new, stored, "k").collect()] == ["a"]


@pytest.mark.parametrize("grains", [[], ["day"], ["hour", "day"], ["minute", "hour", "week"]])
def test_lag_within_buckets_is_the_plain_lag(spark, grains):
    rng = random.Random(5)
    base = datetime(2026, 1, 1, tzinfo=UTC)
    rows = [
        ("hot" if rng.random() < 0.6 else rng.choice("ab"), base + timedelta(minutes=37 * i), rng.randrange(50))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, t timestamp, v bigint")
    out = keys.lag_within(df, ["k"], "t", ["v"], [F.date_trunc(g, "t") for g in grains])
    whole = Window.partitionBy("k").orderBy("t", "v")
    want = df.withColumns({"prev_t": F.lag("t").over(whole), "prev_v": F.lag("v").over(whole)})
    assert sorted(map(str, out.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_tower_state_newest_wins_and_ties_keep_the_stored_row(spark):
    at = "2026-07-17T10:00:0{}+00:00"
    events = accepted(spark, [
        ("tower-events", event("tower-events", "1", timestamp=at.format(0), signal_strength=80)),
        ("tower-events", event("tower-events", "2", timestamp=at.format(5), signal_strength=55)),
        ("tower-events", event("tower-events", "3", tower_id="JHB-SDT-001", timestamp=at.format(1), signal_strength=90)),
        ("tower-events", event("tower-events", "4", timestamp="2026-07-17T09:59:59+00:00", signal_strength=99)),
        ("tower-events", event("tower-events", "5", timestamp=at.format(5), signal_strength=11)),
        ("tower-events", event("tower-events", "6", tower_id="DBN-CBD-001", timestamp=at.format(0), signal_strength=12)),
    ])
    stored = spark.createDataFrame(
        [("DBN-CBD-001", "3G", 77, 1, "DOWN", datetime(2026, 7, 17, 10, tzinfo=UTC)),
         ("KIM-CBD-001", "3G", 66, 1, "DOWN", datetime(2026, 7, 1, tzinfo=UTC))],
        "tower_id string, technology string, signal_strength bigint, connected_devices bigint,"
        " status string, updated_at timestamp",
    )
    state = {r["tower_id"]: r["signal_strength"] for r in star.tower_state(events, stored).collect()}
    assert state == {"CPT-CBD-001": 55, "JHB-SDT-001": 90, "DBN-CBD-001": 77, "KIM-CBD-001": 66}


def subscribers(spark, *rows):
    return spark.createDataFrame(
        [(i, i, msisdn, "Prepaid", "Gauteng", AS_OF, True) for i, msisdn in rows],
        "subscriber_key bigint, subscriber_id bigint, msisdn string, plan string, province string,"
        " created_at timestamp, is_active boolean",
    )


def test_new_subscribers(spark):
    topic = "subscriber-created"
    events = accepted(spark, [
        (topic, event(topic, "1", subscriber_id=1, msisdn="27000000009")),  # stored id: ignored
        (topic, event(topic, "2", subscriber_id=2, msisdn="27000000002")),
        (topic, event(topic, "3", subscriber_id=2, msisdn="27000000003")),  # second of id 2: ignored
        (topic, event(topic, "4", subscriber_id=4, msisdn="27000000002")),  # number of id 2
        (topic, event(topic, "5", subscriber_id=5, msisdn="27000000001")),  # number of stored id 1
        (topic, event(topic, "6", subscriber_id=6, msisdn="27000000006")),
    ])
    rows, rejects = star.new_subscribers(events, subscribers(spark, (1, "27000000001")))
    assert {(r["subscriber_id"], r["msisdn"]) for r in rows.collect()} == {(2, "27000000002"), (6, "27000000006")}
    assert {(r["offset"], r["reason"]) for r in rejects.collect()} == {
        (3, "REFERENTIAL:msisdn_duplicate"), (4, "REFERENTIAL:msisdn_duplicate")}


def test_facts_and_referential_rejects(spark):
    events = accepted(spark, [
        ("airtime-purchases", event("airtime-purchases", amount=10.005)),
        ("airtime-purchases", event("airtime-purchases", "x", subscriber_id=77)),
        ("voice-calls", event("voice-calls", timestamp="2026-07-17T01:00:00+02:00")),
        ("tower-events", event("tower-events")),
    ])
    resolved = star.resolve_subjects(events, subscribers(spark, (1, "27000000001")))
    dims = Mart.of(dim_tower=catalog.tower_seed(spark), dim_bundle=catalog.bundle_seed(spark))
    recharge = star.fact_rows("airtime_purchase", resolved, dims).collect()
    assert [(str(r["amount"]), r["date_key"]) for r in recharge] == [("10.01", 20260717)]
    call = star.fact_rows("voice_call", resolved, dims).first()
    assert (call["tower_key"], call["date_key"]) == (1, 20260716)  # day of the UTC instant
    lost = star.unknown_subscribers(resolved).collect()
    assert [(r["offset"], r["reason"]) for r in lost] == [(1, "REFERENTIAL:subscriber_unknown")]
    no_towers = dims.with_tables(dim_tower=dims["dim_tower"].where("false"))
    assert star.unmatched_dims("voice_call", resolved, no_towers).count() == 1


def test_hot_keys_survive_without_broadcast(spark):
    """A third of the rows on one subscriber: the same facts with and without broadcast joins."""
    records = [
        ("sms", event("sms", str(i), sender_id=1 if i % 3 == 0 else i)) for i in range(120)
    ]
    events = accepted(spark, records)
    dim = subscribers(spark, *[(i, str(i)) for i in range(0, 120, 2)], (1, "1"))
    want = star.resolve_subjects(events, dim).where("subject_key is not null").count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = star.resolve_subjects(events, dim).where("subject_key is not null").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want == len([i for i in range(120) if i % 3 == 0 or i % 2 == 0 or i == 1])


def test_dead_letters_round_trip(spark):
    raw = raw_frame(spark, [("sms", "{broken"), ("sms", None), ("sms", "{broken")])
    rejects = validate.rejected(validate.validate(raw, Reference.seeded(spark), AS_OF))
    published = deadletter.to_broker(deadletter.envelope(rejects, AS_OF)).withColumnRenamed("value", "raw")
    junk = raw_frame(spark, [("failed-transactions", "x"), ("failed-transactions", '{"event_id": 1}')])
    taken = deadletter.intake(published.unionByName(junk))
    assert taken.where("skipped").count() == 2
    rows = deadletter.records(taken).collect()
    assert sorted(r["original_payload"] for r in rows) == ["", "{broken"]
    assert {r["rejected_at"] for r in rows} == {AS_OF.replace(tzinfo=None)}


def test_affected_minutes(spark):
    df = spark.sql("select timestamp'2026-01-01 10:00:59' as event_timestamp union all"
                   " select timestamp'2026-01-01 10:07:01'")
    row = rollups.affected_minutes(df).first()
    assert [t.strftime("%H:%M:%S") for t in row] == ["10:00:00", "10:07:00", "10:08:00"]


def metrics_frame(spark, rows):
    base = datetime(2026, 1, 1, tzinfo=UTC)
    data = [("q", topic, p, base + timedelta(seconds=s), latest, done) for topic, p, s, latest, done in rows]
    return spark.createDataFrame(data, metrics.METRICS_SCHEMA)


def test_rate_and_reset(spark):
    df = metrics_frame(spark, [("a", 0, 0, 0, 0), ("a", 0, 60, 120, 0), ("a", 0, 120, 30, 0), ("a", 1, 0, 5, 0), ("a", 1, 60, 65, 0)])
    rows = {r["minute"].minute: (r["messages"], r["rate_per_second"]) for r in metrics.ingest_rate(df).collect()}
    assert rows == {1: (180, 3.0), 2: (0, 0.0)}


def test_alerts(spark):
    def minutes(alert):
        return {r["minute"].minute for r in alert.where("firing").collect()}

    # Above from minute 2 on: held for five minutes at minute 7.
    lag = [("a", 0, 60 * m, 100, 100 - (60 if m >= 2 else 10)) for m in range(10)]
    assert minutes(metrics.lag_alert(metrics_frame(spark, lag), 50)) == {7, 8, 9}
    assert minutes(metrics.lag_alert(metrics_frame(spark, lag[5:6]), 50)) == set()
    # The last message at minute 3: the rate is zero from minute 8 on, held at minute 13.
    still = [("a", 0, 60 * m, min(m, 3) * 10, 0) for m in range(16)]
    at = lambda minute: datetime(2026, 1, 1, 0, minute, 30, tzinfo=UTC)
    assert minutes(metrics.stall_alert(metrics_frame(spark, still), at(15))) == {13, 14, 15}
    assert minutes(metrics.stall_alert(metrics_frame(spark, still[8:11]), at(10))) == set()
    # Silence counts: of a recorder that died, and of one that missed ten minutes of a stall.
    assert minutes(metrics.stall_alert(metrics_frame(spark, still[:4]), at(16))) == {13, 14, 15, 16}
    assert minutes(metrics.stall_alert(metrics_frame(spark, still[:4] + still[14:]), at(15))) == {13, 14, 15}
    moving = [("a", 0, 60 * m, 10 * m, 0) for m in (0, 1, 2, 14, 15)]
    assert minutes(metrics.stall_alert(metrics_frame(spark, moving), at(15))) == {12, 13}
    assert minutes(metrics.stall_alert(metrics_frame(spark, []), at(15))) == set()


def test_idle_queries_are_sampled_again(spark, tmp_path):
    report = {"name": "events", "timestamp": "2026-01-01T10:00:00.000Z", "sources": [
        {"endOffset": '{"calls": {"0": 5}}', "latestOffset": '{"calls": {"0": 9}}'}]}
    recorder = progress.ProgressRecorder(spark, str(tmp_path / "progress"))
    idle = SimpleNamespace(runId="r", timestamp="2026-01-01T10:01:00.000Z")
    recorder.onQueryIdle(idle)
    recorder.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(runId="r", json=json.dumps(report))))
    recorder.onQueryIdle(idle)
    rows = progress.source_offsets(spark.read.parquet(recorder.path)).orderBy("sampled_at").collect()
    assert [(r["sampled_at"].minute, r["latest_offset"], r["committed_offset"]) for r in rows] == [(0, 9, 5), (1, 9, 5)]


# --- Quality ---------------------------------------------------------------------------------


def clean_mart(spark):
    who = subscribers(spark, (1, "27000000001"), (2, "27000000002"))
    when = datetime(2026, 7, 17, 10, tzinfo=UTC)
    facts = "event_id string, event_timestamp timestamp, subscriber_key bigint"
    return Mart.of(
        dim_subscriber=who,
        dim_tower=catalog.tower_seed(spark),
        dim_bundle=catalog.bundle_seed(spark),
        fact_recharges=spark.createDataFrame([("e1", when, 1, 5.0)], f"{facts}, amount double"),
        fact_bundle_sales=spark.createDataFrame([("e2", when, 1, 1, 99.0)], f"{facts}, bundle_key bigint, price double"),
        fact_calls=spark.createDataFrame(
            [("e3", when, 1, 1, 60)],
            "event_id string, event_timestamp timestamp, caller_key bigint, tower_key bigint, duration_seconds int"),
        fact_sms=spark.createDataFrame(
            [("e4", when, 1, 9)], "event_id string, event_timestamp timestamp, sender_key bigint, length int"),
        fact_data_usage=spark.createDataFrame(
            [("e5", when, 1, 1, 5.0, "LTE")], f"{facts}, tower_key bigint, mb_used double, technology string"),
        tower_status_current=spark.createDataFrame([(80, "HEALTHY")], "signal_strength int, status string"),
    )


PLANTED = [
    ("fact_recharges", {"amount": -50.0}, ("amount", "between")),
    ("fact_recharges", {"amount": 0.0}, ("amount", "between")),
    ("fact_recharges", {"event_id": None}, ("event_id", "not_null")),
    ("fact_recharges", {}, ("event_id", "unique")),
    ("fact_recharges", {"subscriber_key": 99}, ("subscriber_key", "references")),
    ("fact_recharges", {"subscriber_key": None}, ("subscriber_key", "not_null")),
    ("fact_recharges", {"event_timestamp": datetime(2026, 7, 17, 12, 2, tzinfo=UTC)}, ("event_timestamp", "max_at_most")),
    ("fact_bundle_sales", {"bundle_key": 99}, ("bundle_key", "references")),
    ("fact_calls", {"duration_seconds": 21601}, ("duration_seconds", "between")),
    ("fact_sms", {"length": 0}, ("length", "between")),
    ("fact_data_usage", {"technology": "9G"}, ("technology", "in_set")),
    ("dim_subscriber", {"msisdn": "123"}, ("msisdn", "matches")),
    ("tower_status_current", {"status": "ON_FIRE"}, ("status", "in_set")),
]


def test_clean_mart_passes(spark):
    report = quality.report(clean_mart(spark), AS_OF)
    quality.require_success(report)
    assert report.count() == 42 and quality.verdicts(report).where("success").count() == 7


@pytest.mark.parametrize("table, change, failing", PLANTED)
def test_planted_row_is_caught(spark, table, change, failing):
    mart = clean_mart(spark)
    good = mart[table].limit(1)
    fresh = {"event_id": "planted"} if "event_id" in good.columns and failing[1] != "unique" else {}
    planted = good.withColumns({c: F.lit(v).cast(good.schema[c].dataType) for c, v in {**fresh, **change}.items()})
    suite = quality.suites(AS_OF)[table]
    report = quality.check(table, mart[table].unionByName(planted), suite, mart)
    failed = {(r["column_name"], r["expectation"]) for r in report.where("not success").collect()}
    assert failing in failed
    if table != "dim_subscriber":  # a second row of the same subscriber is also a duplicate
        assert failed == {failing}
    with pytest.raises(quality.QualityError):
        quality.require_success(report)


def test_contract_rejects_other_columns(spark):
    batch = validate.events_of(accepted(spark, [("sms", event("sms"))]), "sms")
    report = quality.contract_check("sms", batch, clean_mart(spark), AS_OF)
    quality.require_success(report)
    with pytest.raises(quality.QualityError):
        quality.contract_check("sms", batch.withColumn("extra", F.lit(1)), clean_mart(spark), AS_OF)


def test_large_counters_do_not_stop_the_load(spark):
    big = 3_000_000_000
    raw = raw_frame(spark, [("tower-events", event("tower-events", "1", connected_devices=big))])
    stored = spark.createDataFrame(
        [],
        "tower_id string, technology string, signal_strength bigint, connected_devices bigint,"
        " status string, updated_at timestamp",
    )
    typed = validate.parsed(validate.with_event_type(raw))
    assert star.tower_state(typed, stored).first()["connected_devices"] == big
