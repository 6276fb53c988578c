"""The telecom model as views over the TPC-H-like tables, for the registered queries.

Fixture code, not engine code: it only shapes columns, every operator under test comes from
`signalmart.operators` and `signalmart.plans`. `oracle.py` holds the DuckDB twin of each view.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart import catalog, session
from signalmart.functions import times
from signalmart.operators import deadletter, keys, rollups, star, validate
from signalmart.operators.rules import Reference
from signalmart.plans.kpi import Window
from signalmart.sources.mart import Mart

# events.event_type -> model event type; "error" rows are texts or tower reports by parity.
SOURCE_TYPES = {
    "purchase": "airtime_purchase",
    "signup": "bundle_purchase",
    "click": "voice_call",
    "view": "data_usage",
}


def _pick(values: tuple[str, ...], index: Column) -> Column:
    """Element `index` of a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _uuid_like(text: Column) -> Column:
    digest = F.md5(text)
    return F.concat_ws(
        "-",
        *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))],
    )


def _msisdn(number: Column) -> Column:
    return F.concat(F.lit("27"), F.lpad(number.cast("string"), 9, "0"))


class Model:
    """Lazy views for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.prepare(spark)
        self.sf_dir = sf_dir
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        """A driver table; opened once, since opening reads the file footer."""
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._sources[name]

    @cached_property
    def as_of(self) -> Column:
        """Clock of the data: the newest event, as a scalar subquery."""
        return self.source("events").agg(F.max("ts").cast("timestamp")).scalar()

    @property
    def window(self) -> Window:
        """Tiles look back 24 hours, series 30 days: both hold rows at every scale."""
        return Window(self.as_of, self.as_of - F.make_dt_interval(days=F.lit(30)), self.as_of, 24)

    # --- Dimensions --------------------------------------------------------------------------

    @cached_property
    def subscribers(self) -> DataFrame:
        """All customers; every tenth has another id, so references to the old one are unknown subscribers."""
        key = F.col("c_custkey")
        subscriber = key + F.when(key % 10 == 0, 1_000_000_000).otherwise(0)
        return (
            self.source("customer")
            .select(
                subscriber.alias("subscriber_key"),
                subscriber.alias("subscriber_id"),
                _msisdn(key).alias("msisdn"),
                _pick(catalog.PLANS, key % 3).alias("plan"),
                _pick(catalog.PROVINCES, F.col("c_nationkey") % 9).alias("province"),
                (
                    F.lit("2024-01-01").cast("timestamp")
                    + F.make_dt_interval(mins=(key % 40000).cast("int"))
                ).alias("created_at"),
                (F.col("c_acctbal") >= 0).alias("is_active"),
            )
        )

    @cached_property
    def towers(self) -> DataFrame:
        key = F.col("s_suppkey")
        tech = F.array(*[F.lit(t) for t in catalog.TECHNOLOGIES])
        return self.source("supplier").select(
            key.alias("tower_key"),
            F.col("s_name").alias("tower_id"),
            F.concat(F.lit("Tower "), key.cast("string")).alias("tower_name"),
            _pick(catalog.PROVINCES, F.col("s_nationkey") % 9).alias("province"),
            F.slice(tech, 1, (key % 3 + 1).cast("int")).alias("technologies"),
        )

    @cached_property
    def bundles(self) -> DataFrame:
        return self.source("part").select(
            F.col("p_partkey").alias("bundle_key"),
            F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("bundle_code"),
            F.col("p_name").alias("bundle_name"),
            F.col("p_type").alias("bundle_type"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Days from the first order to the last event."""
        first = self.source("orders").agg(F.min("o_orderdate").cast("date").alias("first_day"))
        last = self.source("events").agg(F.max("ts").cast("date").alias("last_day"))
        return catalog.calendar(first.join(last, F.lit(True)))

    @cached_property
    def reference(self) -> Reference:
        return Reference(self.towers, self.bundles)

    # --- Typed events (the clean stream) -----------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        """Wide typed events, one per source event, without injected faults; no list prices."""
        return self._typed(self._shaped.withColumn("list_price", F.lit(None).cast("double")))

    @cached_property
    def priced_events(self) -> DataFrame:
        """The same with the list price of the bundle on bundle purchases."""
        return self._typed(self._priced)

    @cached_property
    def _priced(self) -> DataFrame:
        prices = self.bundles.select("bundle_key", F.col("price").cast("double").alias("list_price"))
        return self._shaped.join(keys.shuffled(prices), "bundle_key", "left")

    @cached_property
    def _shaped(self) -> DataFrame:
        n = F.col("event_id")
        money = F.col("value").cast("decimal(10,2)")
        kind = F.when(F.col("event_type") == "error", F.when(n % 2 == 0, "sms").otherwise("tower_status"))
        for source_type, model_type in SOURCE_TYPES.items():
            kind = kind.when(F.col("event_type") == source_type, model_type)
        return self.source("events").select(
            n.alias("n"),
            "user_id",
            money.alias("money"),
            F.floor(F.col("value") * 40).alias("ticks"),
            F.col("ts").cast("timestamp").alias("event_timestamp"),
            kind.alias("event_type"),
            (n % 200).alias("bundle_key"),
        )

    def _typed(self, shaped: DataFrame) -> DataFrame:
        n, kind = F.col("n"), F.col("event_type")
        caller = kind.isin("airtime_purchase", "bundle_purchase", "data_usage")

        def only(condition: Column, value: Column) -> Column:
            return F.when(condition, value)

        signal = n % 101
        return shaped.select(
            catalog.topic_of(kind).alias("topic"),
            (n % 3).cast("int").alias("partition"),
            n.alias("offset"),
            kind,
            "event_timestamp",
            _uuid_like(n.cast("string")).alias("event_id"),
            kind.alias(catalog.DECLARED_TYPE),
            F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            F.lit(1).cast("bigint").alias("schema_version"),
            only(caller, F.col("user_id")).alias("subscriber_id"),
            only(kind == "voice_call", F.col("user_id")).alias("caller_id"),
            only(kind == "sms", F.col("user_id")).alias("sender_id"),
            only(kind == "airtime_purchase", F.col("money").cast("double")).alias("amount"),
            only(kind == "airtime_purchase", _pick(catalog.PAYMENT_METHODS, n % 4)).alias("payment_method"),
            only(
                kind == "bundle_purchase", F.concat(F.lit("B"), F.col("bundle_key").cast("string"))
            ).alias("bundle_code"),
            only(kind == "bundle_purchase", F.col("list_price")).alias("price"),
            only(kind.isin("voice_call", "sms"), _msisdn(n % 1000000)).alias("receiver_msisdn"),
            only(kind == "voice_call", F.col("ticks")).alias("duration_seconds"),
            only(kind == "voice_call", n % 33 == 0).alias("dropped"),
            only(kind == "sms", n % 320 + 1).alias("length"),
            only(kind == "data_usage", F.col("money").cast("double")).alias("mb_used"),
            only(kind == "data_usage", n % 7200 + 10).alias("session_seconds"),
            only(
                kind.isin("voice_call", "data_usage", "tower_status"),
                F.concat(F.lit("Supplier#"), F.lpad((n % 10).cast("string"), 9, "0")),
            ).alias("tower_id"),
            only(
                kind.isin("data_usage", "tower_status"), _pick(catalog.TECHNOLOGIES, n % 3)
            ).alias("technology"),
            only(kind == "tower_status", signal).alias("signal_strength"),
            only(kind == "tower_status", n % 5000).alias("connected_devices"),
            only(
                kind == "tower_status",
                F.when(signal < 45, "DOWN").when(signal < 60, "DEGRADED").otherwise("HEALTHY"),
            ).alias("status"),
        )

    @cached_property
    def line_sales(self) -> DataFrame:
        """Bundle purchases from order lines: the large fact, with natural duplicate ids."""
        buyers = self.source("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        minute = F.make_dt_interval(mins=((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 1440).cast("int"))
        return self.source("lineitem").join(buyers, "l_orderkey").select(
            F.lit("bundle_purchase").alias("event_type"),
            _uuid_like(F.concat_ws("-", F.lit("L"), F.col("l_orderkey"), F.col("l_linenumber"))).alias("event_id"),
            (F.col("l_shipdate").cast("timestamp") + minute).alias("event_timestamp"),
            F.col("o_custkey").alias("subscriber_id"),
            F.concat(F.lit("B"), F.col("l_partkey").cast("string")).alias("bundle_code"),
            F.floor(F.col("l_extendedprice") / 1000).cast("double").alias("price"),
            "l_suppkey",
        )

    def first_line_sales(self) -> DataFrame:
        """Order-line purchases with first-wins identity; the order is total up to equal rows."""
        order = [F.col(c).asc() for c in ("event_timestamp", "bundle_code", "price", "l_suppkey")]
        return keys.first_per_key(self.line_sales, ["event_id"], order)

    # --- Facts and rollups from the clean stream ---------------------------------------------

    @cached_property
    def mart(self) -> Mart:
        """Every table of the star, built when first asked for; source event ids are unique."""
        builders: dict[str, Callable[[], DataFrame]] = {
            "dim_subscriber": lambda: self.subscribers,
            "dim_tower": lambda: self.towers,
            "dim_bundle": lambda: self.bundles,
            "dim_date": lambda: self.calendar,
            "tower_status_current": lambda: star.tower_state(self.events, self.no_state()),
            "dlq_records": lambda: self.dead_letters,
        }
        for event_type, spec in star.FACTS.items():
            builders[spec.table] = partial(self._fact, event_type)
        mart = Mart(builders)
        for name, (build, _) in {**rollups.FACT_ROLLUPS, **rollups.DLQ_ROLLUPS}.items():
            builders[name] = partial(build, mart)
        return mart

    def _fact(self, event_type: str) -> DataFrame:
        spec = star.FACTS[event_type]
        source = self.priced_events if event_type == "bundle_purchase" else self.events
        known = self.subscribers.select(
            F.col("subscriber_id").alias(spec.subject), F.col("subscriber_key").alias("subject_key")
        )
        events = source.where(F.col("event_type") == event_type).join(keys.shuffled(known), spec.subject)
        dims = self.mart.with_tables(dim_bundle=keys.shuffled(self.bundles))
        return star.fact_rows(event_type, events, dims)

    def no_state(self) -> DataFrame:
        return self.spark.createDataFrame(
            [],
            "tower_id string, technology string, signal_strength int, connected_devices int,"
            " status string, updated_at timestamp",
        )

    @cached_property
    def dead_letters(self) -> DataFrame:
        """Dead-letter table: every fourth error text plus declined payments, from the events."""
        declined = (F.col("event_type") == "airtime_purchase") & (F.col("offset") % 25 == 7)
        faulty = (F.col("event_type") == "sms") & (F.col("offset") % 8 == 0)
        reason = F.when(declined, "PAYMENT_DECLINED").when(faulty, "RULE_VIOLATION:length_positive")
        payload = F.to_json(
            F.struct(
                "event_id",
                F.col(catalog.DECLARED_TYPE).alias("event_type"),
                "timestamp",
                "schema_version",
                "subscriber_id",
                "amount",
                "payment_method",
            )
        )
        return (
            self.events.withColumn("rejection_reason", reason)
            .where(F.col("rejection_reason").isNotNull())
            .select(
                "event_id",
                F.col("topic").alias("source_topic"),
                "rejection_reason",
                F.when(declined, payload)
                .otherwise(F.concat(F.lit('{"offset":'), F.col("offset").cast("string"), F.lit("}")))
                .alias("original_payload"),
                F.col("event_timestamp").alias("rejected_at"),
                times.date_key_of("event_timestamp").alias("date_key"),
            )
        )

    # --- Raw stream with labelled faults -----------------------------------------------------

    @cached_property
    def raw(self) -> DataFrame:
        """Broker-shaped JSON records of all seven topics, a fault per `offset % 50`."""
        return self._event_records().unionByName(self._subscriber_records())

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Dealt over all cores while they are narrow: a few MB of a packed file hold minutes of parsing.

        The number is given, since rows this small would be gathered into a few tasks by their size.
        """
        return rows.repartition(4 * self.spark.sparkContext.defaultParallelism)

    def _event_records(self) -> DataFrame:
        e = self._typed(self._spread(self._priced))
        fault = F.col("offset") % 50
        kind = F.col("event_type")

        def broken(label: int, value: str | Column, otherwise: Column, only: str | None = None) -> Column:
            hit = fault == label if only is None else (fault == label) & (kind == only)
            return F.when(hit, value).otherwise(otherwise)

        def number(name: str) -> Column:
            return F.col(name).cast("string")

        def text(column: Column) -> Column:
            return F.concat(F.lit('"'), column, F.lit('"'))

        late = F.date_format(
            self.as_of + F.make_dt_interval(hours=F.lit(2)), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        )
        amount = F.col("amount").cast("decimal(10,2)").cast("string")
        megabytes = F.col("mb_used").cast("decimal(10,2)").cast("string")
        price = F.col("price").cast("decimal(10,2)")
        members: dict[str, list[tuple[str, Column]]] = {
            "airtime_purchase": [
                ("subscriber_id", number("subscriber_id")),
                ("amount", broken(4, "-50.00", broken(8, "5000.00", amount))),
                ("payment_method", text(broken(6, "Cash", F.col("payment_method")))),
            ],
            "bundle_purchase": [
                ("subscriber_id", broken(8, "true", number("subscriber_id"))),
                ("bundle_code", text(broken(6, "NO-BUNDLE", F.col("bundle_code")))),
                ("price", broken(4, (price + 1).cast("string"), price.cast("string"))),
            ],
            "voice_call": [
                ("caller_id", number("caller_id")),
                ("receiver_msisdn", text(broken(8, "0821234567", F.col("receiver_msisdn")))),
                ("duration_seconds", broken(4, "-5", broken(18, "21601", number("duration_seconds")))),
                ("tower_id", text(broken(6, "NO-TOWER", F.col("tower_id")))),
                ("dropped", F.col("dropped").cast("string")),
            ],
            "sms": [
                ("sender_id", number("sender_id")),
                ("receiver_msisdn", text(broken(8, "0821234567", F.col("receiver_msisdn")))),
                ("length", broken(4, "0", broken(6, "5000", number("length")))),
            ],
            "data_usage": [
                ("subscriber_id", number("subscriber_id")),
                ("mb_used", broken(4, "0", broken(18, "10240.5", megabytes))),
                ("session_seconds", broken(8, "0", broken(19, "3000000000", number("session_seconds")))),
                ("tower_id", text(F.col("tower_id"))),
                ("technology", text(broken(6, "9G", F.col("technology")))),
            ],
            "tower_status": [
                ("tower_id", text(F.col("tower_id"))),
                ("technology", text(F.col("technology"))),
                ("signal_strength", broken(4, "250", number("signal_strength"))),
                ("connected_devices", broken(8, "-1", broken(19, "5000000000", number("connected_devices")))),
                ("status", text(broken(6, "ON_FIRE", F.col("status")))),
            ],
        }

        def body(pairs: list[tuple[str, Column]]) -> Column:
            """The payload; label 16 has a null for its first field, label 17 lacks it."""
            (first, value), *rest = pairs
            parts = [broken(17, "", F.concat(F.lit(f',"{first}":'), broken(16, "null", value)))]
            for name, value in rest:
                parts += [F.lit(f',"{name}":'), value]
            return F.concat(*parts)

        payload = None
        for name, pairs in members.items():
            payload = (
                F.when(kind == name, body(pairs))
                if payload is None
                else payload.when(kind == name, body(pairs))
            )
        version = (
            F.when(fault.isin(1, 12), "")
            .when(fault == 2, ',"schema_version":"one"')
            .otherwise(',"schema_version":1')
        )
        whole = F.concat(
            F.lit("{"),
            broken(14, "", F.concat(F.lit('"event_id":"'), broken(11, "not-a-uuid", F.col("event_id")), F.lit('",'))),
            F.lit('"event_type":"'),
            kind,
            F.lit('","timestamp":'),
            broken(13, "5", text(broken(5, late, F.col("timestamp")))),
            version,
            payload,
            F.when(fault.isin(3, 12), ',"discount":10').when(fault == 15, ',"zeta":1,"alpha":null').otherwise(""),
            F.when(fault == 0, "").when(fault == 9, "} x").otherwise("}"),
        )
        # Label 7 is sent twice; the copy arrives later under another offset.
        copies = F.sequence(F.lit(0), F.when(fault == 7, 1).otherwise(0))
        return e.select(
            "topic",
            "partition",
            "offset",
            broken(10, "[1,2]", whole).alias("raw"),
            F.explode(copies).alias("copy"),
        ).select(
            "topic",
            "partition",
            (F.col("offset") + F.col("copy") * 1_000_000_000_000).alias("offset"),
            "raw",
        )

    def _subscriber_records(self) -> DataFrame:
        """Registrations; of every twenty one breaks each of the rules, and one breaks all of them."""
        key = F.col("subscriber_id")
        fault = key % 20
        return self._spread(self.subscribers).select(
            F.lit("subscriber-created").alias("topic"),
            (key % 3).cast("int").alias("partition"),
            key.alias("offset"),
            F.concat(
                F.lit('{"event_id":"'),
                _uuid_like(F.concat(F.lit("S"), key.cast("string"))),
                F.lit('","event_type":"subscriber_created","timestamp":"'),
                F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                F.lit('","schema_version":1,"subscriber_id":'),
                key.cast("string"),
                F.lit(',"msisdn":"'),
                F.when(fault.isin(1, 4), "0821234567").otherwise(F.col("msisdn")),
                F.lit('","plan":"'),
                F.when(fault.isin(2, 4), "Free").otherwise(F.col("plan")),
                F.lit('","province":"'),
                F.when(fault.isin(3, 4), "Atlantis").otherwise(F.col("province")),
                F.lit('"}'),
            ).alias("raw"),
        )

    @cached_property
    def validated(self) -> DataFrame:
        return validate.validate(self.raw, self.reference, self.as_of)

    @cached_property
    def accepted(self) -> DataFrame:
        """Accepted events, first arrival of each id per topic."""
        return keys.first_per_key(
            validate.accepted(self.validated), ["topic", "event_id"], keys.arrival_order()
        )

    @cached_property
    def resolved(self) -> DataFrame:
        return star.resolve_subjects(self.accepted, self.subscribers)

    @cached_property
    def rejects(self) -> DataFrame:
        return validate.rejected(self.validated)

    @cached_property
    def envelopes(self) -> DataFrame:
        return deadletter.envelope(self.rejects, self.as_of)

    # --- Pipeline metrics --------------------------------------------------------------------

    @cached_property
    def metrics(self) -> DataFrame:
        """One offset sample per event; offsets stand still in runs of forty ids."""
        n = F.col("event_id")
        head = n - n % 40
        return self.source("events").select(
            F.lit("events").alias("query"),
            F.col("event_type").alias("topic"),
            (n % 3).cast("int").alias("partition"),
            F.col("ts").cast("timestamp").alias("sampled_at"),
            head.alias("latest_offset"),
            (head - n % 7).alias("committed_offset"),
        )

    # --- Times in every form -------------------------------------------------------------------

    @cached_property
    def timestamps(self) -> DataFrame:
        """The time of every event, written in one of the forms by its number."""
        t, n = F.col("ts"), F.col("event_id")
        day, basic = F.date_format(t, "yyyy-MM-dd"), F.date_format(t, "yyyyMMdd")
        clock, tight = F.date_format(t, "HH:mm:ss"), F.date_format(t, "HHmmss")
        hour, minute = F.date_format(t, "HH"), F.date_format(t, "HH:mm")
        micros = F.date_format(t, "SSSSSS")
        year, week = F.expr("CAST(extract(YEAROFWEEK FROM ts) AS STRING)"), F.lpad(F.weekofyear(t).cast("string"), 2, "0")
        weekday = (F.weekday(t) + 1).cast("string")
        join = F.concat
        lit = F.lit
        forms = [
            join(day, lit("T"), clock, lit("."), micros, lit("Z")), join(basic, lit("T"), tight, lit("Z")),
            join(basic, lit("T"), tight, lit(","), micros), join(day, lit("T"), hour), join(day, lit("T"), minute),
            join(day, lit("t"), clock), join(day, lit("_"), clock, lit("+00")), join(basic, lit(" "), F.date_format(t, "HHmm")),
            day, basic,
            join(year, lit("-W"), week, lit("-"), weekday, lit("T"), clock, lit("Z")),
            join(year, lit("W"), week, weekday, lit("T"), tight), join(year, lit("-W"), week), join(year, lit("W"), week),
            join(day, lit("T"), clock, lit("+05:30")), join(day, lit("T"), clock, lit("-0330")),
            join(day, lit("T"), clock, lit("+05:30:15")), join(day, lit("T"), clock, lit("-23:59:59.5")),
            join(day, lit("T"), clock, lit(" +02:00")),
            # None of these is a time.
            join(day, lit("T")), join(day, lit("T"), clock, lit("+24:00")), join(day, lit("T"), hour, lit(":60")),
            join(day, lit("T24:00")), join(F.substring(day, 1, 7)), join(year, lit("-W54-1")),
            join(year, lit("-W"), week, lit("-8")), join(day, lit("T"), clock, lit("z")), join(day, lit("T"), clock, lit("Z ")),
            join(F.substring(day, 1, 8), lit("32")), lit(""),
        ]
        form = n % len(forms)
        return self.source("events").select(
            n.alias("offset"), form.cast("int").alias("form"), F.element_at(F.array(*forms), (form + 1).cast("int")).alias("text")
        )
