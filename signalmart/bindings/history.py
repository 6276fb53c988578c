"""Marts written in several batches, for the queries that show how a store grows.

Rows arrive by their day of the month, late ones (the first minutes of every hour) in a last batch, and every
batch sends the rows of the one before it again with other contents, which must change nothing. The first
batches are merged before the last one comes, so it meets merged and recent segments.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart import catalog, session
from signalmart.bindings.model import Model
from signalmart.operators import keys, rollups, star, validate
from signalmart.plans import load
from signalmart.sources import lake
from signalmart.sources.batch import Batch, concurrently
from signalmart.sources.mart import Mart
from signalmart.sources.store import Store

TIMES = {**{table: "event_timestamp" for table in star.FACT_TABLES}, "dlq_records": "rejected_at"}
N_BATCHES = 4

#: Stores built in this session, by data directory.
_built: dict[tuple[str, str, str], Store] = {}


def measure(table: str) -> Column:
    """The measure that stands for a fact's contents in the results."""
    column = {
        "fact_recharges": "amount", "fact_bundle_sales": "price", "fact_calls": "duration_seconds",
        "fact_sms": "length", "fact_data_usage": "mb_used",
    }.get(table)
    return F.col(column).cast("double") if column else F.lit(0.0)


def _new_store(m: Model, kind: str) -> tuple[Store, bool]:
    key = (m.spark.sparkContext.applicationId, m.sf_dir, kind)
    if key in _built:
        return _built[key], False
    shared = session.scratch_dir(m.spark, "") or tempfile.mkdtemp(prefix="signalmart-history-")
    store = _built[key] = load.open_store(m.spark, f"{shared}/history-{kind}-{uuid.uuid4().hex}")
    return store, True


def _arrival(table: str) -> Column:
    """Number of the batch a row comes with."""
    return F.when(F.minute(TIMES[table]) < 5, N_BATCHES - 1).otherwise(F.col("date_key") % (N_BATCHES - 1))


def _sent(table: str, rows: DataFrame, number: int) -> DataFrame:
    """The rows of one batch: its own, and those of the batch before it, a day later and under a new key."""
    of = rows.withColumn("_arrival", _arrival(table))
    own = of.where(F.col("_arrival") == number).drop("_arrival")
    again = of.where(F.col("_arrival") == number - 1).drop("_arrival")
    changed = {TIMES[table]: F.col(TIMES[table]) + F.make_dt_interval(days=F.lit(1))}
    for column in ("amount", "price", "duration_seconds", "length", "mb_used"):
        if column in rows.columns:
            changed[column] = (F.col(column) + 1).cast(dict(rows.dtypes)[column])
    return own.unionByName(again.withColumns(changed))


def _write(batch: Batch, tables: dict[str, DataFrame], dims: DataFrame, rollups_: dict) -> None:
    """One batch: facts by id, the sums over the new ones, one commit."""
    spark = batch.store.spark
    concurrently(spark, [partial(batch.insert, table, rows) for table, rows in tables.items()])
    own = Mart({**{table: partial(batch.own, table) for table in tables}, "dim_subscriber": lambda: keys.shuffled(dims)})
    concurrently(spark, [lambda n=n, b=b: batch.write(n, b(own)) for n, (b, _) in rollups_.items()])
    batch.commit()


def mart(m: Model) -> Store:
    """The facts, dead letters and rollups of all batches."""
    store, new = _new_store(m, "mart")
    if new:
        facts = {}
        for table in TIMES:
            path = f"{store.staging}/all/{table}"
            m.mart[table].write.parquet(path)
            facts[table] = m.spark.read.schema(m.mart[table].schema).parquet(path)
        for number in range(N_BATCHES):
            sent = {table: _sent(table, rows, number) for table, rows in facts.items()}
            dead = {"dlq_records": sent.pop("dlq_records")}
            _write(store.begin(load.EVENTS_QUERY, number), sent, m.subscribers, rollups.FACT_ROLLUPS)
            _write(store.begin(load.DLQ_QUERY, number), dead, m.subscribers, rollups.DLQ_ROLLUPS)
            if number == N_BATCHES - 2:
                for query in (load.EVENTS_QUERY, load.DLQ_QUERY):
                    store.compact(query, fan=2)
    return store


def registrations(m: Model) -> tuple[Store, list[DataFrame]]:
    """The base after three batches of registrations on top of its inactive half, and each batch's rejects."""
    store, _ = _new_store(m, f"base-{uuid.uuid4().hex}")
    orders = m.source("orders")
    events = orders.select(
        F.lit("subscriber_created").alias("event_type"),
        F.lit("subscriber-created").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"),
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.lit("{}").alias("raw"),
        F.col("o_custkey").alias("subscriber_id"),
        F.concat(F.lit("27"), F.lpad(F.floor(F.col("o_custkey") / 2).cast("string"), 9, "0")).alias("msisdn"),
        F.col("o_orderpriority").alias("plan"),
        F.col("o_orderstatus").alias("province"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
    )
    last = orders.agg(F.max("o_orderkey") + 1).scalar()
    arrival = F.floor(F.col("offset") * 3 / last) + 1
    rejects = []
    for number in range(4):
        batch = store.begin(load.EVENTS_QUERY, number)
        if number:
            lost = load.new_subscribers(batch, events.where(arrival == number))
            path = f"{store.staging}/rejects-{number}"
            lost.select("offset", "reason").write.parquet(path)
            rejects.append(m.spark.read.parquet(path))
        else:
            batch.write("dim_subscriber", m.subscribers.where(~F.col("is_active")))
            batch.write("ids/msisdn", batch.own("dim_subscriber").select(F.col("msisdn").alias("key")))
        batch.commit()
        if number == 2:  # the last batch meets merged and recent segments
            store.compact(load.EVENTS_QUERY, fan=2)
    return store, [lost.join(events, "offset") for lost in rejects]


def judge_once(m: Model) -> None:
    """Stage the model's verdicts as a batch does, so that accepted and rejected come from one parse."""
    store, _ = _new_store(m, f"verdicts-{uuid.uuid4().hex}")
    subjects = dict.fromkeys(spec.subject for spec in star.FACTS.values())
    narrow = m.validated.select(*validate.RAW_COLUMNS, "event_type", "event_id", *subjects, "reason")
    m.validated = load.staged(store, narrow, "verdicts")


def lakes(m: Model) -> Store:
    """The accepted events in two batches, the second with the first one's again."""
    store, new = _new_store(m, "lake")
    if new:
        path = f"{store.staging}/accepted"
        schema = m.accepted.schema
        m.accepted.write.partitionBy("event_type").parquet(path)
        accepted = m.spark.read.schema(schema).parquet(path)
        for number in range(2):
            batch = store.begin(load.EVENTS_QUERY, number)
            events = accepted if number else accepted.where(F.col("offset") % 2 == 0)
            concurrently(
                m.spark,
                [
                    partial(batch.write, f"lake/{kind}", lake.rows(validate.events_of(events, kind), number))
                    for kind in catalog.EVENT_TYPES
                ],
            )
            batch.commit()
    return store
