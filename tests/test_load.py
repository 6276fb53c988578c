"""Batch loads and streams into a stored mart: exact rows, replay, batch equals stream."""

import json
import shutil
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from signalmart import catalog
from signalmart.bindings import registry
from signalmart.bindings.model import Model
from signalmart.operators import keys, quality, rollups, validate
from signalmart.plans import kpi, load
from signalmart.sources import lake, manifest, records
from signalmart.sources.batch import Batch
from signalmart.sources.mart import Mart
from signalmart.sources.sinks import FileSink, KafkaSink
from signalmart.sources.store import bucket_of
from signalmart.streaming import jobs, progress, windows
from tests.events import BODIES, event, raw_frame

AS_OF = datetime(2026, 7, 17, 12, tzinfo=UTC)


def stream_records():
    """Known events with known faults, in arrival order, in three slices."""
    def at(hour, minute):
        return {"timestamp": f"2026-07-{hour // 24 + 16:02d}T{hour % 24:02d}:{minute:02d}:30+00:00"}

    first = [
        ("subscriber-created", event("subscriber-created", "s1")),
        ("subscriber-created", event("subscriber-created", "s2", subscriber_id=2, msisdn="27000000002")),
        ("airtime-purchases", event("airtime-purchases", "a1", amount=10.0, **at(30, 1))),
        ("airtime-purchases", event("airtime-purchases", "a1", amount=11.0, **at(30, 1))),
        ("airtime-purchases", event("airtime-purchases", "a2", subscriber_id=99)),
        ("sms", "{truncated"),
        ("tower-events", event("tower-events", "t1", signal_strength=40, **at(30, 0))),
    ]
    second = [
        ("bundle-purchases", event("bundle-purchases", "b1", subscriber_id=2, **at(30, 1))),
        ("bundle-purchases", event("bundle-purchases", "b2", price=1.0)),
        ("airtime-purchases", event("airtime-purchases", "a1", amount=12.0, **at(30, 1))),
        ("voice-calls", event("voice-calls", "v1", dropped=True, **at(30, 2))),
        ("voice-calls", event("voice-calls", "v2", duration_seconds=30, **at(30, 2))),
        ("tower-events", event("tower-events", "t2", signal_strength=70, **at(30, 5))),
        ("subscriber-created", event("subscriber-created", "s3", subscriber_id=3, msisdn="27000000002")),
    ]
    third = [
        ("data-usage", event("data-usage", "d1", **at(31, 0))),
        ("sms", event("sms", "m1", sender_id=2, **at(31, 0))),
        ("airtime-purchases", event("airtime-purchases", "a3", amount=4.5, **at(0, 1))),  # late
        ("tower-events", event("tower-events", "t3", signal_strength=10, **at(30, 1))),  # older
        ("sms", event("sms", "m2", length=0)),
    ]
    return [first, second, third]


def slices(spark):
    out, offset = [], 0
    for part in stream_records():
        df = raw_frame(spark, part).withColumn("offset", F.col("offset") + offset)
        out.append(df)
        offset += len(part)
    return out


def snapshot(store):
    """Comparable content of every table, without batch bookkeeping."""
    out = {}
    for name, df in store.mart.items():
        if not name.startswith(("batch_", "source_")):
            out[name] = sorted(str(tuple(r)) for r in df.collect())
    for event_type in catalog.EVENT_TYPES:
        rows = store.read_lake(event_type).drop("batch_id").collect()
        out[f"lake/{event_type}"] = sorted(str(tuple(r)) for r in rows)
    return out


def fresh_store(spark, path):
    store = load.open_store(spark, str(path / "mart"))
    store.seed()
    return store, FileSink(str(path / "dead-letters"))


def load_dead_letters(spark, store, sink):
    messages = validate.decode(spark.read.schema(records.BROKER_SCHEMA).parquet(sink.path))
    load.run_dead_letter_batch(messages, store, 0)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    store, sink = fresh_store(spark, tmp_path_factory.mktemp("loaded"))
    for batch_id, raw in enumerate(slices(spark)):
        load.run_batch(raw, store, batch_id, sink, as_of=AS_OF)
    load_dead_letters(spark, store, sink)
    return store, sink


def test_exact_rows(loaded):
    store, _ = loaded
    mart = store.mart

    def rows(table, *columns):
        return sorted(tuple(str(v) for v in r) for r in mart[table].select(*columns).collect())

    assert rows("dim_subscriber", "subscriber_id", "msisdn") == [("1", "27821234567"), ("2", "27000000002")]
    assert rows("fact_recharges", "subscriber_key", "amount", "date_key") == [
        ("1", "10.00", "20260717"), ("1", "4.50", "20260716")]
    assert rows("fact_bundle_sales", "subscriber_key", "bundle_key", "price") == [("2", "1", "99.00")]
    assert rows("fact_calls", "duration_seconds", "dropped") == [("30", "False"), ("60", "True")]
    assert rows("fact_sms", "sender_key") == [("2",)]
    assert rows("fact_data_usage", "mb_used") == [("12.50",)]
    assert rows("tower_status_current", "tower_id", "signal_strength") == [("CPT-CBD-001", "70")]
    assert rows("dlq_records", "source_topic", "rejection_reason") == [
        ("airtime-purchases", "REFERENTIAL:subscriber_unknown"),
        ("bundle-purchases", "RULE_VIOLATION:price_matches_catalog"),
        ("sms", "PARSE_ERROR"),
        ("sms", "RULE_VIOLATION:length_positive"),
        ("subscriber-created", "REFERENTIAL:msisdn_duplicate"),
    ]
    assert rows("agg_revenue_minute", "minute", "province", "revenue_type", "total_amount", "txn_count") == [
        ("2026-07-16 00:01:00", "Gauteng", "AIRTIME", "4.50", "1"),
        ("2026-07-17 06:01:00", "Gauteng", "AIRTIME", "10.00", "1"),
        ("2026-07-17 06:01:00", "Gauteng", "BUNDLE", "99.00", "1"),
    ]
    assert rows("agg_calls_minute", "tower_key", "call_count", "dropped_count", "total_duration") == [("1", "2", "1", "90")]
    assert rows("agg_dlq_minute", "record_count") == [("1",)] * 5


def test_invariants(loaded):
    store, _ = loaded
    assert quality.orphan_calls(store.mart).first()["orphans"] == 0
    assert {r["duplicates"] for r in quality.duplicate_events(store.mart).collect()} == {0}
    assert quality.fact_total(store.mart).first()["total_rows"] == 7
    quality.require_success(quality.report(store.mart, AS_OF))
    quality.require_success(quality.constraints(store.mart))


def test_lake_keeps_validated_events_once_per_batch(loaded):
    store, _ = loaded
    events = store.read_lake("airtime_purchase")
    assert events.count() == 4  # a1 in two batches, a2 although its subscriber is unknown, a3
    assert events.where("date = '2026-07-16'").count() == 1


def test_lake_replay_is_pruned_and_gives_each_event_once(loaded):
    store, _ = loaded
    all_days = lake.replay(store, "airtime_purchase").collect()
    assert sorted(r["amount"] for r in all_days) == [4.5, 10.0, 50.0]  # the repeated one as it first came
    late = lake.replay(store, "airtime_purchase", "2026-07-16", "2026-07-16")
    assert [r["amount"] for r in late.collect()] == [4.5]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "InMemoryFileIndex(1 paths)" in plan, plan
    assert len(late.inputFiles()) < len(lake.replay(store, "airtime_purchase").inputFiles())
    assert lake.replay(store, "airtime_purchase", "2020-01-01", "2020-01-02").count() == 0


def test_kpis_run_on_stored_tables_and_prune_days(loaded):
    store, _ = loaded
    window = kpi.Window(as_of=AS_OF, lo=datetime(2026, 7, 17, tzinfo=UTC), hi=AS_OF, tile_hours=12)
    for name, build in kpi.KPIS.items():
        build(store.mart, window).collect()
    revenue = kpi.kpi_revenue_last_hour(store.mart, window)
    assert str(revenue.first()["revenue"]) == "109.00"
    assert str(kpi.kpi_arpu(store.mart, window).first()["arpu"]).startswith("54.5")
    plan = revenue._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan, plan


def test_sql_views(loaded, spark):
    store, _ = loaded
    store.register_views()
    assert spark.sql("select count(*) from fact_calls join dim_tower using (tower_key)").first()[0] == 2


def test_replay_of_the_last_batch_changes_nothing(spark, tmp_path):
    store, sink = fresh_store(spark, tmp_path)
    parts = slices(spark)
    load.run_batch(parts[0], store, 0, sink, as_of=AS_OF)
    load.run_batch(parts[1], store, 1, sink, as_of=AS_OF)
    before = snapshot(store)
    sent = spark.read.parquet(sink.path).count()
    # A later wall clock must not change the verdicts of a replay.
    load.run_batch(parts[1], store, 1, sink, as_of=datetime(2020, 1, 1, tzinfo=UTC))
    assert snapshot(store) == before
    assert spark.read.parquet(sink.path).count() == sent


class Stop(Exception):
    pass


def test_nothing_of_a_failed_batch_is_seen(spark, tmp_path, monkeypatch):
    """A batch stopped at any of its steps leaves the mart as it was; the next attempt completes it."""
    parts = slices(spark)
    store, sink = fresh_store(spark, tmp_path / "a")
    load.run_batch(parts[0], store, 0, sink, as_of=AS_OF)
    before = snapshot(store)
    clean, clean_sink = fresh_store(spark, tmp_path / "b")
    load.run_batch(parts[0], clean, 0, clean_sink, as_of=AS_OF)
    steps = []
    write = Batch.write
    with monkeypatch.context() as patch:
        patch.setattr(Batch, "write", lambda self, table, rows: (steps.append(table), write(self, table, rows))[1])
        load.run_batch(parts[1], clean, 1, clean_sink, as_of=AS_OF)
    assert {"dim_subscriber", "lake/voice_call", "fact_calls", "ids/fact_calls", "agg_calls_minute",
            "tower_status_current", "batch_metrics"} <= set(steps)

    def stops(table):
        def stopped(self, name, rows):
            done = write(self, name, rows)
            if name == table:
                raise Stop(table)
            return done

        return stopped

    for table in ("dim_subscriber", "lake/voice_call", "ids/fact_calls", "agg_revenue_minute"):
        with monkeypatch.context() as patch, pytest.raises(Stop):
            patch.setattr(Batch, "write", stops(table))
            load.run_batch(parts[1], store, 1, sink, as_of=AS_OF)
        assert snapshot(store) == before, table

    class Broken:
        def publish(self, envelopes, batch_id):
            raise Stop

    with pytest.raises(Stop):
        load.run_batch(parts[1], store, 1, Broken(), as_of=AS_OF)
    assert snapshot(store) == before
    # The clock of the first attempt holds: a later one must not judge otherwise.
    load.run_batch(parts[1], store, 1, sink, as_of=datetime(2020, 1, 1, tzinfo=UTC))
    assert snapshot(store) == snapshot(clean)
    store.sweep(load.EVENTS_QUERY)  # what the failed attempts left
    kept = store.log(load.EVENTS_QUERY).retained()
    left = {f"fact_calls/{name}" for name in store.folder.names("fact_calls")}
    assert left and left <= kept and snapshot(store) == snapshot(clean)


def test_replay_replaces_the_whole_newest_batch(spark, tmp_path):
    """A replay that brings fewer days leaves one version, its own; an older batch is final."""
    store, sink = fresh_store(spark, tmp_path / "a")
    parts = slices(spark)
    load.run_batch(parts[0], store, 0, sink, as_of=AS_OF)
    load.run_batch(parts[2].unionByName(parts[1]), store, 1, sink, as_of=AS_OF)
    assert store.read("fact_recharges").where("date_key = 20260716").count() == 1
    load.run_batch(parts[1], store, 1, sink, as_of=AS_OF)
    clean, clean_sink = fresh_store(spark, tmp_path / "b")
    for number in (0, 1):
        load.run_batch(parts[number], clean, number, clean_sink, as_of=AS_OF)
    assert snapshot(store) == snapshot(clean)
    load.run_batch(parts[2], store, 2, sink, as_of=AS_OF)
    done = snapshot(store)
    load.run_batch(parts[2], store, 1, sink, as_of=AS_OF)
    assert snapshot(store) == done


def call(number, day=1, hour=0):
    at = datetime(2026, 7, day, hour, number % 60, tzinfo=UTC)
    return (f"abcdef00-0000-4000-8000-{number:012d}", at, 1, 1, "27821234567", 60, False, 20260700 + day)


def add_calls(store, number, rows):
    frame = store.spark.createDataFrame(rows, store.schema("fact_calls"))
    batch = store.begin(load.EVENTS_QUERY, number)
    if batch.insert("fact_calls", frame):
        batch.write("agg_calls_minute", rollups.calls_minute(Mart.of(fact_calls=batch.own("fact_calls"))))
    batch.commit()


def test_merging_keeps_contents_and_bounds_the_folders(spark, tmp_path, monkeypatch):
    store = load.open_store(spark, str(tmp_path / "mart"))
    for number in range(10):
        # Each batch repeats calls of earlier ones, one in upper case; one minute gets calls of many batches.
        rows = [call(number, day=1 + number % 3), call(100 + number, day=1)]
        if number:
            rows += [(call(0)[0].upper(), *call(0)[1:]), call(number - number // 2 - 1 or number - 1, day=9)]
        rows = list({row[0].lower(): row for row in rows}.values())
        add_calls(store, number, rows)
    calls, minutes = snapshot(store)["fact_calls"], snapshot(store)["agg_calls_minute"]
    assert len(calls) == 20 and len(store.segments("fact_calls")) == 10
    old = store.read("fact_calls")  # a reader that started before the merges
    while store.compact(load.EVENTS_QUERY, fan=3):
        assert snapshot(store)["fact_calls"] == calls and snapshot(store)["agg_calls_minute"] == minutes
    assert sorted(str(tuple(r)) for r in old.collect()) == calls
    segments = store.segments("fact_calls")
    assert len(segments) <= 3 and max(s.level for s in segments) >= 1
    # The newest batch can still be replaced, and known ids are known in merged segments.
    add_calls(store, 9, [call(9, day=1), call(3), call(0)])
    assert store.read("fact_calls").count() == 19
    monkeypatch.setattr(manifest, "RETAIN", 2)
    for number in range(10, 16):
        add_calls(store, number, [call(number), call(number - 9)])
        store.compact(load.EVENTS_QUERY, fan=3)
        # Folders: those in use, and those that kept manifests still name.
        assert len(store.folder.names("fact_calls")) <= 16
        assert len(store.log(load.EVENTS_QUERY).versions()) <= 4
    assert store.read("fact_calls").count() == store.read("fact_calls").select("event_id").distinct().count()
    folded = store.read("agg_calls_minute").groupBy().sum("call_count").first()[0]
    assert folded == store.read("fact_calls").count()


def test_lookup_reads_the_buckets_of_the_batch_only(spark, tmp_path):
    store = load.open_store(spark, str(tmp_path / "mart"))
    for number in range(4):
        add_calls(store, number, [call(1000 * number + i) for i in range(300)])
    store.compact(load.EVENTS_QUERY, fan=3)
    batch = store.begin(load.EVENTS_QUERY, 4)
    new = spark.createDataFrame([call(7), call(3007), call(99_999)], store.schema("fact_calls"))
    keyed = new.select(keys.id_bytes("event_id").alias("key"))
    found = batch.lookup("ids/fact_calls", keyed)
    assert found.count() == 2
    buckets = {r[0] for r in keyed.select(bucket_of("key")).collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan, plan
    opened = {r[0] for r in found.select(F.input_file_name()).collect()}
    assert any("/bucket=" in name for name in opened)
    assert {int(n.split("/bucket=")[1].split("/")[0]) for n in opened if "/bucket=" in n} <= buckets
    assert "PushedFilters: [" in plan and "In(key" in plan, plan


def write_source(spark, folder):
    """Each slice as one broker-shaped file; file order is arrival order."""
    for number, part in enumerate(slices(spark)):
        staged = folder.parent / f"staged-{number}"
        part.withColumn("value", F.col("raw").cast("binary")).drop("raw").coalesce(1).write.parquet(str(staged))
        folder.mkdir(exist_ok=True)
        data = next(staged.glob("part-*.parquet"))
        shutil.copy(data, folder / f"{number}.parquet")


def run_stream(spark, job, folder, sink):
    job.start_events(records.file_stream(spark, str(folder), max_files=1)).awaitTermination()
    job.start_dead_letters(records.file_stream(spark, sink.path)).awaitTermination()


def test_stream_equals_batches_and_survives_replay(spark, tmp_path, loaded):
    folder = tmp_path / "source"
    write_source(spark, folder)
    store, sink = fresh_store(spark, tmp_path)
    spark.streams.addListener(recorder := progress.ProgressRecorder(spark, str(tmp_path / "progress")))
    job = jobs.Jobs(
        store, sink, str(tmp_path / "checkpoints"), jobs.Trigger(available_now=True), {"as_of": AS_OF}
    )
    run_stream(spark, job, folder, sink)
    streamed = snapshot(store)
    assert streamed == snapshot(loaded[0])
    counts = store.read("batch_metrics").where("query = 'events'").groupBy("accepted").sum("n_records")
    assert {r[0]: r[1] for r in counts.collect()} == {True: 13, False: 5}

    # Restart with nothing new.
    run_stream(spark, job, folder, sink)
    assert snapshot(store) == streamed

    # Forget the last commit: the restart runs that batch again under its old number.
    commits = Path(job.checkpoints) / load.EVENTS_QUERY / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    run_stream(spark, job, folder, sink)
    assert snapshot(store) == streamed
    spark.streams.removeListener(recorder)
    assert spark.read.parquet(str(tmp_path / "progress")).count() > 0


def test_watermarked_windows_and_dedupe(spark, tmp_path):
    folder = tmp_path / "events"
    schema = "event_id string, event_timestamp timestamp, tower_id string, dropped boolean, duration_seconds bigint"
    batches = [
        [("a", "08:00:10"), ("b", "08:00:20"), ("a", "08:00:10")],
        [("b", "08:00:20"), ("c", "08:01:00"), ("d", "08:30:00")],
        [("f", "08:59:00")],
        [("e", "08:00:30"), ("g", "09:59:00")],  # e is an hour late: its window is closed
    ]
    for number, rows in enumerate(batches):
        data = [(i, datetime.fromisoformat(f"2026-07-17T{t}+00:00"), "T", False, 1) for i, t in rows]
        staged = tmp_path / f"staged-{number}"
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(staged))
        folder.mkdir(exist_ok=True)
        shutil.copy(next(staged.glob("part-*.parquet")), folder / f"{number}.parquet")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    calls = windows.calls_per_minute(windows.dedupe(stream, "10 minutes"), None)
    out = tmp_path / "out"
    (
        calls.writeStream.format("parquet").option("path", str(out))
        .option("checkpointLocation", str(tmp_path / "cp")).outputMode("append")
        .trigger(availableNow=True).start().awaitTermination()
    )
    got = {r["minute"].strftime("%H:%M"): r["call_count"] for r in spark.read.parquet(str(out)).collect()}
    assert got == {"08:00": 2, "08:01": 1, "08:30": 1, "08:59": 1}


def test_kafka_options():
    options = records.kafka_options("b:9092", records.event_topics())
    assert options["subscribe"].split(",") == list(BODIES)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in options and options["failOnDataLoss"] == "false"
    bounded = records.kafka_options("b:9092", ("t",), max_records=5, fail_on_data_loss=True)
    assert bounded["maxOffsetsPerTrigger"] == "5" and bounded["failOnDataLoss"] == "true"
    assert KafkaSink("b:9092").options()["kafka.acks"] == "all"


def test_progress_reports_become_metrics(spark):
    report = {
        "name": "events", "timestamp": "2026-07-17T10:00:05.000Z",
        "sources": [{"endOffset": json.dumps({"sms": {"0": 5, "1": 7}}),
                     "latestOffset": json.dumps({"sms": {"0": 9, "1": 7}})}],
    }
    df = spark.createDataFrame([(json.dumps(report),)], "report string")
    rows = {(r["topic"], r["partition"]): (r["latest_offset"], r["committed_offset"])
            for r in progress.source_offsets(df).collect()}
    assert rows == {("sms", 0): (9, 5), ("sms", 1): (7, 7)}


def test_lost_records_are_reported(spark, tmp_path):
    """Records a broker dropped between two batches leave a row; a replay reports them once."""
    store, sink = fresh_store(spark, tmp_path)
    at = lambda offset: raw_frame(spark, [("sms", event("sms", str(offset)))]).withColumn("offset", F.lit(offset).cast("long"))
    for number, offsets in enumerate([(0, 1), (2,), (9, 12)]):
        raw = at(offsets[0])
        for offset in offsets[1:]:
            raw = raw.unionByName(at(offset))
        load.run_batch(raw, store, number, sink, as_of=AS_OF)
    load.run_batch(at(9).unionByName(at(12)), store, 2, sink, as_of=AS_OF)
    columns = ["topic", "expected_offset", "found_offset", "batch_id"]
    assert [tuple(r) for r in store.read("source_gaps").select(*columns).collect()] == [("sms", 3, 9, 2)]
    assert [r["next_offset"] for r in store.read("source_positions").collect()] == [13]


def test_skipped_dead_letters_stay_with_their_text(spark, tmp_path):
    store = load.open_store(spark, str(tmp_path / "mart"))
    for batch, text in enumerate(("not json", "[1]")):
        raw = raw_frame(spark, [("failed-transactions", text)])
        load.run_dead_letter_batch(raw, store, batch)
    rows = store.read("dlq_skipped").select("raw", "cause").collect()
    assert sorted(map(tuple, rows)) == [("[1]", "not_an_object"), ("not json", "PARSE_ERROR")]


def test_marts_with_equal_names_have_their_own_staging(spark, tmp_path):
    places = {load.open_store(spark, str(tmp_path / x / "mart"), str(tmp_path)).staging for x in ("a", "b")}
    assert len(places) == 2


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_that_grow_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Stored and wanted ids, subscribers and bundles meet the facts in shuffled joins, not through the driver."""
    monkeypatch.setattr("signalmart.sources.batch.LOOKUP", 10)
    store = load.open_store(spark, str(tmp_path / "mart"))
    add_calls(store, 0, [call(i) for i in range(40)])
    batch = store.begin(load.EVENTS_QUERY, 1)
    rows = spark.createDataFrame([call(i) for i in range(20, 60)], store.schema("fact_calls"))
    found = batch.lookup("ids/fact_calls", rows.select(keys.id_bytes("event_id").alias("key")))
    fresh = batch.fresh("fact_calls", rows)
    assert (found.count(), fresh.count()) == (20, 20)
    assert "BroadcastExchange" not in plan_of(found) + plan_of(fresh)

    sales = small_model(spark, tmp_path).mart["fact_bundle_sales"]
    assert sales.count() == 18  # the tenth subscriber has another id
    assert "BroadcastExchange" not in plan_of(sales)


def small_model(spark, folder):
    """Nineteen bundle purchases of as many subscribers."""
    for name, sql in {
        "customer": "id AS c_custkey, CAST(1 AS INT) AS c_nationkey, 1.0D AS c_acctbal",
        "supplier": "id AS s_suppkey, 'Supplier#1' AS s_name, CAST(1 AS INT) AS s_nationkey",
        "part": "id AS p_partkey, 'p' AS p_name, 't' AS p_type, 9.0D AS p_retailprice",
        "events": "id AS event_id, TIMESTAMP '2024-01-01 00:00:00' AS ts, id AS user_id, 'signup' AS event_type, 1.0D AS value",
    }.items():
        spark.range(1, 20).selectExpr(*sql.split(", ")).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return Model(spark, str(folder))


def test_records_of_small_files_are_parsed_on_all_cores(spark, tmp_path):
    raw = small_model(spark, tmp_path).raw
    assert raw.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert raw.count() == 39  # one is sent twice


def test_counts_parse_records_once(spark, tmp_path):
    small_model(spark, tmp_path)
    counts = registry.QUERIES["batch_counts"](spark, str(tmp_path))
    assert "parse_json" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert sum(r.n_records for r in counts.collect()) == 38


def test_the_lake_of_a_type_parses_its_topic_only(spark, tmp_path):
    model = small_model(spark, tmp_path)
    sold = validate.events_of(model.accepted, "bundle_purchase")
    plan = sold._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan, plan  # registrations are of another topic
    assert sold.count() == model.accepted.where(F.col("event_type") == "bundle_purchase").count() > 0
