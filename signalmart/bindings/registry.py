"""Every operator as a named query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalmart import catalog
from signalmart.bindings import history
from signalmart.bindings.model import Model
from signalmart.functions import times
from signalmart.operators import deadletter, keys, metrics, quality, rollups, star, validate
from signalmart.plans import kpi
from signalmart.sources import lake
from signalmart.streaming import progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _portable(df: DataFrame) -> DataFrame:
    """Column types every engine reports alike: no decimals, time zones, arrays or small ints."""

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ShortType):
            value = value.cast("int")
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, ",")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(fn: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: _portable(fn(Model(spark, sf_dir)))
    return fn


# --- Sources ---------------------------------------------------------------------------------


@query
def decode_raw(m: Model) -> DataFrame:
    records = m.raw.select(
        "topic", "partition", "offset", F.encode("raw", "utf-8").alias("value")
    )
    return validate.decode(records).select("topic", "partition", "offset", F.md5("raw").alias("raw_md5"))


@query
def topic_event_type(m: Model) -> DataFrame:
    return validate.with_event_type(m.raw).select("topic", "offset", "event_type")


@query
def seed_dims(m: Model) -> DataFrame:
    """Catalogue towers and bundles with the number of suppliers and parts bound to each."""
    towers = catalog.tower_seed(m.spark).select(
        F.lit("tower").alias("dimension"), F.col("tower_key").alias("key"),
        F.col("tower_id").alias("code"), F.col("tower_name").alias("name"),
        F.array_join("technologies", ",").alias("detail"),
    )
    bundles = catalog.bundle_seed(m.spark).select(
        F.lit("bundle").alias("dimension"), F.col("bundle_key").alias("key"),
        F.col("bundle_code").alias("code"), F.col("bundle_name").alias("name"),
        F.concat_ws(":", "bundle_type", F.col("price").cast("string")).alias("detail"),
    )
    bound = (
        m.towers.select(F.lit("tower").alias("dimension"), (F.col("tower_key") % 18 + 1).alias("key"))
        .unionByName(
            m.bundles.select(F.lit("bundle").alias("dimension"), (F.col("bundle_key") % 8 + 1).alias("key"))
        )
        .groupBy("dimension", "key")
        .agg(F.count("*").alias("n_bound"))
    )
    return (
        towers.unionByName(bundles)
        .join(bound, ["dimension", "key"], "left")
        .withColumn("n_bound", F.coalesce("n_bound", F.lit(0)))
    )


@query
def dim_date(m: Model) -> DataFrame:
    return m.calendar.withColumn("full_date", F.col("full_date").cast("timestamp_ntz"))


@query
def lake_replay(m: Model) -> DataFrame:
    """Events of the last 30 days, each once, from a lake that two batches wrote and the second repeated."""
    newest = m.spark.range(1).select(m.as_of.cast("date").alias("day"))
    first, last = newest.select(F.date_sub("day", 30).cast("string"), F.col("day").cast("string")).first()
    store = history.lakes(m)
    days = [
        lake.replay(store, kind, first, last).select(F.lit(kind).alias("event_type"), "date", "event_id")
        for kind in catalog.EVENT_TYPES
    ]
    return reduce(DataFrame.unionByName, days)


# --- Sinks -----------------------------------------------------------------------------------


@query
def lake_rows(m: Model) -> DataFrame:
    return lake.with_date(validate.events_of(m.accepted, "airtime_purchase"))


@query
def fact_insert_if_absent(m: Model) -> DataFrame:
    """All facts and dead letters after batches that repeat each other's rows with other contents."""
    store = history.mart(m)
    tables = [
        store.read(table).select(
            F.lit(table).alias("table_name"), "event_id", F.col(column).alias("event_timestamp"), "date_key",
            history.measure(table).alias("measure"),
        )
        for table, column in history.TIMES.items()
    ]
    return reduce(DataFrame.unionByName, tables)


@query
def compaction(m: Model) -> DataFrame:
    """Rows, ids and measures per table and day of a mart whose first batches have been merged."""
    store = history.mart(m)
    tables = [
        store.read(table)
        .groupBy(F.lit(table).alias("table_name"), "date_key")
        .agg(
            F.count("*").alias("n_rows"),
            F.countDistinct("event_id").alias("n_ids"),
            F.round(F.sum(history.measure(table)), 2).alias("measure"),
        )
        for table in history.TIMES
    ]
    return reduce(DataFrame.unionByName, tables)


@query
def dim_subscriber_upsert(m: Model) -> DataFrame:
    """Registrations in three batches on top of the inactive half of the base; two ids share a number."""
    store, rejects = history.registrations(m)
    columns = ["subscriber_id", "msisdn", "plan", "province"]
    base = store.read("dim_subscriber").select(
        *columns, "created_at", F.when(F.col("is_active"), "inserted").otherwise("stored").alias("outcome")
    )
    lost = [r.select(*columns, F.col("event_timestamp").alias("created_at"), F.col("reason").alias("outcome")) for r in rejects]
    return reduce(DataFrame.unionByName, lost, base)


@query
def tower_status_current(m: Model) -> DataFrame:
    return m.mart["tower_status_current"]


@query
def dlq_to_json(m: Model) -> DataFrame:
    return deadletter.to_broker(m.envelopes)


@query
def dlq_records(m: Model) -> DataFrame:
    """Rejects published, read back, validated and stored once per id."""
    published = deadletter.to_broker(m.envelopes).withColumnRenamed("value", "raw")
    return deadletter.records(deadletter.intake(published)).drop("rejected_at")


@query
def rollup_refresh(m: Model) -> DataFrame:
    """All four rollups, folded from the partial sums of several batches and a late one."""
    store = history.mart(m)
    keys_of = {
        "agg_revenue_minute": ("province", "revenue_type"), "agg_calls_minute": ("tower_key",),
        "agg_data_minute": ("tower_key", "technology"), "agg_dlq_minute": ("source_topic", "rejection_reason"),
    }
    parts = []
    for name, key in keys_of.items():
        sums = [F.col(c).cast("double") for c in rollups.SUMS[name]]
        parts.append(
            store.read(name).select(
                F.lit(name).alias("rollup"), "minute", "date_key", F.concat_ws("|", *key).alias("key"),
                F.array_join(F.transform(F.array(*sums), lambda x: F.format_number(x, 2)), " ").alias("sums"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def rollup_dlq_minute(m: Model) -> DataFrame:
    return m.mart["agg_dlq_minute"]


@query
def affected_minutes(m: Model) -> DataFrame:
    return rollups.affected_minutes(m.accepted)


# --- Parse and validate ----------------------------------------------------------------------


@query
def parse_verdict(m: Model) -> DataFrame:
    parsed = validate.parsed(validate.with_event_type(m.raw))
    return parsed.select("topic", "offset", F.col("document").isNotNull().alias("parsed"))


@query
def schema_verdict(m: Model) -> DataFrame:
    return validate.schema_violations_of(m.raw).select(
        "topic", "offset", F.coalesce("violations", F.array(F.lit("unparsed"))).alias("violations")
    )


@query
def rule_verdict(m: Model) -> DataFrame:
    """All violated rules of the records that are structurally sound."""
    sound = validate.schema_violations_of(m.raw).where(F.size("violations") == 0)
    raw = sound.select(*validate.RAW_COLUMNS)
    checked = validate.rule_violations_of(raw, m.reference, m.as_of)
    return checked.select("topic", "offset", "violations")


@query
def validate_events(m: Model) -> DataFrame:
    return m.validated.select("topic", "offset", F.coalesce("reason", F.lit("ACCEPTED")).alias("reason"))


@query
def typed_events(m: Model) -> DataFrame:
    measure = F.coalesce(
        "amount", "price", "mb_used", F.col("duration_seconds").cast("double"),
        F.col("length").cast("double"), F.col("signal_strength").cast("double"), F.lit(0.0),
    )
    return validate.accepted(m.validated).select(
        "topic", "offset", "event_id", "event_type", "event_timestamp",
        F.coalesce(star.subject_of(F.col("event_type")), F.lit(-1)).alias("subject_id"),
        measure.alias("measure"),
        F.coalesce("session_seconds", "connected_devices", F.lit(0)).alias("detail"),
    )


@query
def batch_counts(m: Model) -> DataFrame:
    """Accepted: first of their id, of a known subscriber; rejected: all dead letters."""
    history.judge_once(m)
    resolved = m.resolved
    return validate.batch_counts(resolved, m.rejects.unionByName(star.unknown_subscribers(resolved)))


@query
def contract_check(m: Model) -> DataFrame:
    reports = []
    for event_type in catalog.EVENT_TYPES:
        if event_type == "subscriber_created":
            source = validate.accepted(m.validated)
        else:
            source = m.priced_events if event_type == "bundle_purchase" else m.events
        batch = validate.events_of(source, event_type)
        reports.append(quality.contract_check(event_type, batch, m.mart, m.as_of))
    dead = m.envelopes.drop("partition", "offset")
    reports.append(quality.contract_check(deadletter.RECORD_TYPE, dead, m.mart, m.as_of))
    return reduce(DataFrame.unionByName, reports)


@query
def timestamp_forms(m: Model) -> DataFrame:
    """What is read from every form a time can be written in, and from forms that are none."""
    return m.timestamps.select("offset", "form", "text", times.iso_timestamp(F.col("text")).alias("instant"))


# --- Keys and dead letters -------------------------------------------------------------------


@query
def dedupe_first(m: Model) -> DataFrame:
    """Order lines arrive with repeated (order, line) ids; the first of each is kept."""
    return m.first_line_sales().select("event_id", "event_timestamp", "bundle_code", "price", "l_suppkey")


@query
def dlq_uuid5(m: Model) -> DataFrame:
    return m.rejects.select(
        "topic", "offset",
        deadletter.record_id(F.col("topic"), F.col("reason"), F.col("raw")).alias("dlq_id"),
    )


@query
def dlq_envelope(m: Model) -> DataFrame:
    return m.envelopes


@query
def dlq_intake(m: Model) -> DataFrame:
    """The raw stream itself misread as dead letters (all skipped) next to real ones (all taken)."""
    real = deadletter.to_broker(m.envelopes).withColumnRenamed("value", "raw")
    taken = deadletter.intake(real.unionByName(m.raw))
    known = F.when(~F.col("skipped"), F.col("event_id"))
    return taken.select("topic", "offset", known.alias("event_id"), "skipped")


@query
def dlq_skipped(m: Model) -> DataFrame:
    """The raw stream misread as dead letters: kept with its text and the cause."""
    return deadletter.skipped(deadletter.intake(m.raw))


@query
def referential_rejects(m: Model) -> DataFrame:
    return star.unknown_subscribers(m.resolved)


@query
def failed_payment_payloads(m: Model) -> DataFrame:
    return deadletter.declined_payments(m.mart["dlq_records"])


@query
def dlq_reasons(m: Model) -> DataFrame:
    return quality.rejection_reasons(m.mart.with_tables(dlq_records=m.envelopes))


# --- Facts -----------------------------------------------------------------------------------


@query
def fact_recharges(m: Model) -> DataFrame:
    return m.mart["fact_recharges"]


@query
def fact_bundle_sales(m: Model) -> DataFrame:
    """The large fact: deduplicated order lines with their subscriber and bundle keys."""
    resolved = m.first_line_sales().join(
        m.subscribers.select("subscriber_id", F.col("subscriber_key").alias("subject_key")),
        "subscriber_id",
    )
    return star.fact_rows("bundle_purchase", resolved, m.mart)


@query
def fact_calls(m: Model) -> DataFrame:
    return m.mart["fact_calls"]


@query
def fact_sms(m: Model) -> DataFrame:
    return m.mart["fact_sms"]


@query
def fact_data_usage(m: Model) -> DataFrame:
    return m.mart["fact_data_usage"]


@query
def known_subscribers(m: Model) -> DataFrame:
    sales = m.line_sales.select("event_id", "subscriber_id", "bundle_code")
    return star.known_subscribers(sales, m.subscribers, "subscriber_id")


# --- Rollups ---------------------------------------------------------------------------------


@query
def rollup_revenue_minute(m: Model) -> DataFrame:
    """Airtime from the events, bundle revenue from the deduplicated order lines."""
    return rollups.revenue_minute(m.mart.with_tables(fact_bundle_sales=fact_bundle_sales(m)))


@query
def rollup_calls_minute(m: Model) -> DataFrame:
    return m.mart["agg_calls_minute"]


@query
def rollup_data_minute(m: Model) -> DataFrame:
    return m.mart["agg_data_minute"]


# --- Quality and audits ----------------------------------------------------------------------


@query
def quality_report(m: Model) -> DataFrame:
    return quality.report(m.mart, m.as_of)


@query
def audit_orphan_keys(m: Model) -> DataFrame:
    """Calls audited against a dimension that has lost its inactive subscribers."""
    return quality.orphan_calls(m.mart.with_tables(dim_subscriber=m.subscribers.where("is_active")))


@query
def audit_duplicates(m: Model) -> DataFrame:
    """Duplicate event ids per fact; the undeduplicated order lines stand in for bundle sales."""
    return quality.duplicate_events(m.mart.with_tables(fact_bundle_sales=m.line_sales))


@query
def audit_fact_total(m: Model) -> DataFrame:
    return quality.fact_total(m.mart)


@query
def audit_constraints(m: Model) -> DataFrame:
    return quality.constraints(m.mart)


# --- Pipeline metrics ------------------------------------------------------------------------


@query
def source_offsets(m: Model) -> DataFrame:
    """Offsets read out of progress reports, one report per event."""

    def offsets(column: str):
        # {"topic": {"partition": offset}}, as text within the report
        return F.to_json(F.create_map("topic", F.create_map(F.col("partition").cast("string"), F.col(column))))

    stamp = F.date_format("sampled_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    source = F.struct(offsets("committed_offset").alias("endOffset"), offsets("latest_offset").alias("latestOffset"))
    report = F.to_json(F.struct(F.col("query").alias("name"), stamp.alias("timestamp"), F.array(source).alias("sources")))
    return progress.source_offsets(m.metrics.select(report.alias("report")))


@query
def metric_lag(m: Model) -> DataFrame:
    return metrics.consumer_lag(m.metrics)


@query
def metric_rate(m: Model) -> DataFrame:
    return metrics.ingest_rate(m.metrics).withColumn(
        "rate_per_second", F.round("rate_per_second", 6)
    )


@query
def alert_lag(m: Model) -> DataFrame:
    return metrics.lag_alert(m.metrics, threshold=4)


@query
def alert_stalled(m: Model) -> DataFrame:
    return metrics.stall_alert(m.metrics, m.as_of)


# --- KPIs ------------------------------------------------------------------------------------

_ROUNDED = {"kpi_arpu": ("arpu", 3), "kpi_avg_recharge": ("avg_amount", 3)}


def _kpi_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = Model(spark, sf_dir)
        out = _portable(kpi.KPIS[name](model.mart, model.window))
        if name in _ROUNDED:
            column, digits = _ROUNDED[name]
            out = out.withColumn(column, F.round(column, digits))
        return out

    return run


QUERIES.update({name: _kpi_query(name) for name in kpi.KPIS})
