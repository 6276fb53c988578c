"""One batch of raw records into lake, star, state, dead letters and rollups.

The batch writes every table apart and publishes all of them at once; a batch that fails leaves nothing that
is read, and is simply run again. Stored rows are looked up by key in the buckets the batch touches, and
rollups are summed over the batch's own rows, so no step reads the history. Two staged tables hold the
results more than one step needs: the verdicts, so records are parsed once, and the resolved events, so they
are deduplicated and joined once. They are written files in the shared folder, not cached blocks, so a lost
executor costs nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import catalog, session
from signalmart.operators import deadletter, keys, rollups, star, validate
from signalmart.operators.rules import RULES, Reference, Rule
from signalmart.sources import lake, records, sinks
from signalmart.sources.batch import Batch, concurrently
from signalmart.sources.mart import Mart
from signalmart.sources.store import Store

EVENTS_QUERY = "events"
DLQ_QUERY = "dead-letters"


def staged(store: Store, df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result, split by event type, and read it back."""
    path = f"{store.staging}/{name}"
    schema = df.schema
    df.write.mode("overwrite").partitionBy("event_type").parquet(path)
    return store.spark.read.schema(schema).parquet(path)


def new_subscribers(batch: Batch, created: DataFrame) -> DataFrame:
    """Write the batch's new subscribers with the index of their numbers; return the rejects."""
    first = keys.first_per_key(created, ["topic", "event_id"], keys.arrival_order())
    claims = staged(batch.store, star.new_claims(first, batch.lookup("dim_subscriber", created)), "claims")
    numbers = batch.lookup("ids/msisdn", claims.select(F.col("msisdn").alias("key")))
    rows = star.winning_claims(claims, numbers.select(F.col("key").alias("msisdn")))
    batch.write("dim_subscriber", rows)
    own = batch.own("dim_subscriber")
    batch.write("ids/msisdn", own.select(F.col("msisdn").alias("key")))
    return star.lost_claims(claims, own)


def run_batch(
    raw: DataFrame,
    store: Store,
    batch_id: int,
    dead_letter_sink: sinks.DeadLetterSink,
    as_of: datetime | None = None,
    strict: bool = True,
    rules: dict[str, tuple[Rule, ...]] = RULES,
) -> None:
    batch = store.begin(EVENTS_QUERY, batch_id, as_of)
    if batch is None:  # final: newer batches were built on it
        return
    reference = Reference(store.read("dim_tower"), store.read("dim_bundle"))
    verdicts = staged(
        store, validate.validate(raw, reference, batch.clock, strict, rules), "verdicts"
    )
    accepted = validate.accepted(verdicts)
    # At most one row per event type: which steps have anything to do.
    present = {r["event_type"] for r in accepted.select("event_type").distinct().collect()}
    rejects = validate.rejected(verdicts)

    # Subscribers first: events of the same batch may refer to them.
    number_taken = None
    if "subscriber_created" in present:
        created = accepted.where(F.col("event_type") == "subscriber_created")
        number_taken = new_subscribers(batch, created)
        rejects = rejects.unionByName(number_taken)

    subjects = accepted.select(star.subject_of(F.col("event_type")).alias("subscriber_id"))
    unique = keys.first_per_key(accepted, ["topic", "event_id"], keys.arrival_order())
    resolved = staged(
        store,
        star.resolve_subjects(unique, batch.lookup("dim_subscriber", subjects, own=True)),
        "resolved",
    )
    rejects = rejects.unionByName(star.unknown_subscribers(resolved))

    def write_lake(event_type: str) -> None:
        batch.write(f"lake/{event_type}", lake.rows(validate.events_of(resolved, event_type), batch_id))

    def write_facts(event_type: str, spec: star.FactSpec) -> None:
        batch.insert(spec.table, star.fact_rows(event_type, resolved, store.mart))

    def write_state() -> None:
        state = star.tower_state(resolved, batch.before("tower_status_current"))
        batch.replace("tower_status_current", state)

    def write_counts() -> None:
        kept = resolved
        if number_taken is not None:
            lost = number_taken.select("topic", "partition", "offset")
            kept = resolved.join(lost, ["topic", "partition", "offset"], "left_anti")
        _write_counts(batch, EVENTS_QUERY, validate.batch_counts(kept, rejects))

    def write_positions() -> None:
        found, positions = records.gaps(verdicts, batch.before("source_positions"))
        batch.write("source_gaps", found.withColumn("batch_id", F.lit(batch_id).cast("long")))
        batch.replace("source_positions", positions)

    facts = {kind: spec for kind, spec in star.FACTS.items() if kind in present}
    steps = [partial(write_lake, kind) for kind in catalog.EVENT_TYPES if kind in present]
    steps += [partial(write_facts, kind, spec) for kind, spec in facts.items()]
    if "tower_status" in present:
        steps.append(write_state)
    concurrently(store.spark, [*steps, write_counts, write_positions])

    # The subscribers of this batch with their provinces, from the join that has been made.
    known = resolved.where(F.col("subject_key").isNotNull()).select(
        F.col("subject_key").alias("subscriber_key"), F.col("subject_province").alias("province")
    )
    own = Mart({**{spec.table: partial(batch.own, spec.table) for spec in star.FACTS.values()},
                "dim_subscriber": known.distinct})
    added = {spec.table for spec in facts.values() if batch.written[spec.table]}
    due = [(name, build) for name, (build, sources) in rollups.FACT_ROLLUPS.items() if added & set(sources)]
    concurrently(store.spark, [partial(_write_rollup, batch, own, name, build) for name, build in due])

    dead_letter_sink.publish(deadletter.envelope(rejects, batch.clock), batch_id)
    batch.commit()
    store.compact(EVENTS_QUERY)


def _write_rollup(batch: Batch, own: Mart, name: str, build: Callable[[Mart], DataFrame]) -> None:
    """The sums over the batch's own new facts."""
    batch.write(name, build(own))


def _write_counts(batch: Batch, query: str, counts: DataFrame) -> None:
    batch.write("batch_metrics", counts.withColumns({"query": F.lit(query), "batch_id": F.lit(batch.id).cast("long")}))


def run_dead_letter_batch(raw: DataFrame, store: Store, batch_id: int) -> None:
    """Messages of the dead-letter topic into the review table and its rollup."""
    batch = store.begin(DLQ_QUERY, batch_id)
    if batch is None:
        return
    taken = staged(store, deadletter.intake(raw), "dead-letters")
    if batch.insert("dlq_records", deadletter.records(taken)):
        build, _ = rollups.DLQ_ROLLUPS["agg_dlq_minute"]
        _write_rollup(batch, Mart({"dlq_records": partial(batch.own, "dlq_records")}), "agg_dlq_minute", build)
    batch.write("dlq_skipped", deadletter.skipped(taken))
    counts = taken.groupBy("event_type", (~F.col("skipped")).alias("accepted")).agg(
        F.count("*").alias("n_records")
    )
    _write_counts(batch, DLQ_QUERY, counts)
    batch.commit()
    store.compact(DLQ_QUERY)


def open_store(spark: SparkSession, root: str, scratch: str | None = None) -> Store:
    """A store whose staged tables live in the cluster's shared checkpoint folder if it has one."""
    session.prepare(spark)
    shared = session.scratch_dir(spark, scratch or f"{root}/_staging")
    # The whole root is in the name: two marts may end in the same folder name.
    place = hashlib.sha256(root.rstrip("/").encode()).hexdigest()[:16]
    return Store(spark, root, f"{shared}/{place}-staging")
