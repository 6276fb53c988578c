"""At-rest quality: expectations as data, suites per table, audits across tables.

The column checks of a table share one aggregate pass. Uniqueness and reference checks count per
key before they shuffle or join, so a hot key is one row per task and no key list is collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart import catalog
from signalmart.functions import times
from signalmart.sources.mart import Mart


@dataclass(frozen=True)
class Expectation:
    column: str
    name = "expectation"

    def unexpected(self) -> Column:
        """True for a value that breaks the expectation; NULL values never do."""
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(Expectation):
    name = "not_null"

    def unexpected(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class InSet(Expectation):
    values: tuple = ()
    name = "in_set"

    def unexpected(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Between(Expectation):
    low: float | None = None
    high: float | None = None
    strict_low: bool = False
    name = "between"

    def unexpected(self) -> Column:
        value, out = F.col(self.column), F.lit(False)
        if self.low is not None:
            out = out | ((value <= self.low) if self.strict_low else (value < self.low))
        return out if self.high is None else out | (value > self.high)


@dataclass(frozen=True)
class Matches(Expectation):
    pattern: str = ""
    name = "matches"

    def unexpected(self) -> Column:
        return ~F.col(self.column).rlike(self.pattern)


@dataclass(frozen=True)
class AtLeast(Expectation):
    """Smallest value a batch contract allows."""

    low: float = 0
    name = "at_least"

    def unexpected(self) -> Column:
        return F.col(self.column) < self.low


@dataclass(frozen=True)
class NotAfter(Expectation):
    """The newest value must not lie beyond the ceiling."""

    ceiling: object = None
    name = "max_at_most"

    def unexpected(self) -> Column:
        return F.col(self.column) > self.ceiling


@dataclass(frozen=True)
class Parses(Expectation):
    """Text must be a timestamp not beyond the ceiling."""

    ceiling: object = None
    name = "timestamp_valid"

    def unexpected(self) -> Column:
        stamp = times.iso_timestamp(F.col(self.column))
        return ~F.coalesce(stamp <= self.ceiling, F.lit(False))


@dataclass(frozen=True)
class Unique(Expectation):
    name = "unique"


@dataclass(frozen=True)
class References(Expectation):
    dimension: str = ""
    key: str = ""
    name = "references"


REPORT = "table_name string, expectation string, column_name string, evaluated bigint, unexpected bigint"


def _row(table: str, check: Expectation, evaluated: Column, unexpected: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.name).alias("expectation"),
        F.lit(check.column).alias("column_name"),
        evaluated.cast("bigint").alias("evaluated"),
        F.coalesce(unexpected, F.lit(0)).cast("bigint").alias("unexpected"),
    )


def _value_checks(table: str, df: DataFrame, checks: list[Expectation]) -> DataFrame:
    """All per-value checks in one pass over the table."""
    rows = [
        _row(
            table,
            check,
            F.count("*") if isinstance(check, NotNull) else F.count(check.column),
            F.count_if(check.unexpected()),
        )
        for check in checks
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _key_checks(
    table: str, df: DataFrame, checks: list[tuple[Expectation, Column]], mart: Mart
) -> DataFrame:
    """All uniqueness and reference checks of a table in one pass and one shuffle.

    A row becomes one (check, key) pair per check, counted per pair; the keys of the dimensions join the
    counts as pairs of the same kind, so a hot key is one row by then.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("n"), key.cast("string").alias("key")) for n, (_, key) in enumerate(checks)])
    counted = (
        df.select(F.explode(pairs).alias("p"))
        .where(F.col("p.key").isNotNull())
        .groupBy("p.n", "p.key")
        .agg(F.count("*").alias("rows"))
    )
    references = [(n, check) for n, (check, _) in enumerate(checks) if isinstance(check, References)]
    bad = F.when(F.col("rows") > 1, F.col("rows"))
    if references:
        known = reduce(
            DataFrame.unionByName,
            [
                mart[check.dimension].select(
                    F.lit(n).alias("n"), F.col(check.key).cast("string").alias("key"), F.lit(1).alias("hit")
                )
                for n, check in references
            ],
        )
        counted = counted.join(known, ["n", "key"], "left")
        bad = F.when(F.col("n").isin(*[n for n, _ in references]), F.when(F.col("hit").isNull(), F.col("rows"))).otherwise(bad)
    sums = counted.groupBy("n").agg(F.sum("rows").alias("total"), F.sum(bad).alias("bad"))
    # A table without keys has a row for each check, too.
    all_checks = df.sparkSession.range(len(checks)).select(F.col("id").cast("int").alias("n"))
    named = [_row(table, check, F.coalesce("total", F.lit(0)), F.col("bad")) for check, _ in checks]
    return all_checks.join(sums, "n", "left").select(F.element_at(F.array(*named), F.col("n") + 1).alias("r")).select("r.*")


def check(table: str, df: DataFrame, expectations: list[Expectation], mart: Mart) -> DataFrame:
    """One report row per expectation: table, expectation, column, evaluated, unexpected, success."""
    parts = []
    values = [e for e in expectations if not isinstance(e, Unique | References)]
    if values:
        parts.append(_value_checks(table, df, values))
    keyed = [(e, F.col(e.column)) for e in expectations if isinstance(e, Unique | References)]
    if keyed:
        parts.append(_key_checks(table, df, keyed, mart))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("success", F.col("unexpected") == 0)


def _fact_common(subject: str, ceiling: Column) -> list[Expectation]:
    return [
        NotNull("event_id"),
        Unique("event_id"),
        NotNull(subject),
        References(subject, "dim_subscriber", "subscriber_key"),
        NotAfter("event_timestamp", ceiling),
    ]


def suites(as_of: datetime | Column | None = None) -> dict[str, list[Expectation]]:
    ceiling = times.as_time(as_of) + times.minutes(1)
    tower = References("tower_key", "dim_tower", "tower_key")
    return {
        "dim_subscriber": [
            NotNull("subscriber_id"),
            Unique("subscriber_id"),
            Unique("msisdn"),
            Matches("msisdn", catalog.MSISDN_PATTERN),
            InSet("plan", catalog.PLANS),
            InSet("province", catalog.PROVINCES),
        ],
        "fact_recharges": [
            *_fact_common("subscriber_key", ceiling),
            Between("amount", 0, catalog.MAX_RECHARGE, strict_low=True),
        ],
        "fact_bundle_sales": [
            *_fact_common("subscriber_key", ceiling),
            References("bundle_key", "dim_bundle", "bundle_key"),
            Between("price", 0, strict_low=True),
        ],
        "fact_calls": [
            *_fact_common("caller_key", ceiling),
            tower,
            Between("duration_seconds", 0, catalog.MAX_CALL_SECONDS),
        ],
        "fact_data_usage": [
            *_fact_common("subscriber_key", ceiling),
            tower,
            Between("mb_used", 0, catalog.MAX_SESSION_MB, strict_low=True),
            InSet("technology", catalog.TECHNOLOGIES),
        ],
        "fact_sms": [
            *_fact_common("sender_key", ceiling),
            Between("length", 1, catalog.MAX_SMS_LENGTH),
        ],
        "tower_status_current": [
            Between("signal_strength", 0, 100),
            InSet("status", catalog.TOWER_STATUSES),
        ],
    }


def report(mart: Mart, as_of: datetime | Column | None = None) -> DataFrame:
    """All suites over a mart."""
    parts = [check(table, mart[table], suite, mart) for table, suite in suites(as_of).items()]
    return reduce(DataFrame.unionByName, parts)


def verdicts(quality_report: DataFrame) -> DataFrame:
    """Pass or fail per table."""
    return quality_report.groupBy("table_name").agg(F.bool_and("success").alias("success"))


class QualityError(AssertionError):
    """A table or batch broke at least one expectation."""


def require_success(quality_report: DataFrame) -> None:
    """Raise with the first failed expectation; only that one row reaches the driver."""
    worst = quality_report.where(~F.col("success")).orderBy("table_name", "column_name").first()
    if worst is not None:
        raise QualityError(
            f"{worst['table_name']}.{worst['column_name']} {worst['expectation']}:"
            f" {worst['unexpected']} of {worst['evaluated']}"
        )


# --- Batch contracts -------------------------------------------------------------------------


def contract(event_type: str, as_of: datetime | Column | None = None) -> list[Expectation]:
    """Envelope and domain checks for a whole typed batch of one event type."""
    ceiling = times.as_time(as_of) + F.make_dt_interval(secs=F.lit(catalog.CLOCK_SKEW_SECONDS))
    msisdn = Matches("receiver_msisdn", catalog.MSISDN_PATTERN)
    towers = References("tower_id", "dim_tower", "tower_id")
    domain: dict[str, list[Expectation]] = {
        "subscriber_created": [
            AtLeast("subscriber_id", 1),
            Matches("msisdn", catalog.MSISDN_PATTERN),
            InSet("plan", catalog.PLANS),
            InSet("province", catalog.PROVINCES),
        ],
        "airtime_purchase": [
            AtLeast("subscriber_id", 1),
            Between("amount", 0, catalog.MAX_RECHARGE, strict_low=True),
            InSet("payment_method", catalog.PAYMENT_METHODS),
        ],
        "bundle_purchase": [
            AtLeast("subscriber_id", 1),
            References("bundle_code", "dim_bundle", "bundle_code"),
            Between("price", 0, strict_low=True),
        ],
        "voice_call": [
            AtLeast("caller_id", 1),
            msisdn,
            Between("duration_seconds", 0, catalog.MAX_CALL_SECONDS),
            towers,
        ],
        "sms": [AtLeast("sender_id", 1), msisdn, Between("length", 1, catalog.MAX_SMS_LENGTH)],
        "data_usage": [
            AtLeast("subscriber_id", 1),
            Between("mb_used", 0, catalog.MAX_SESSION_MB, strict_low=True),
            Between("session_seconds", 0, strict_low=True),
            towers,
            InSet("technology", catalog.TECHNOLOGIES),
        ],
        "tower_status": [
            towers,
            InSet("technology", catalog.TECHNOLOGIES),
            Between("signal_strength", 0, 100),
            AtLeast("connected_devices", 0),
            InSet("status", catalog.TOWER_STATUSES),
        ],
        "dlq_record": [],
    }
    return [
        *[NotNull(name) for name, _ in catalog.fields(event_type)],
        Matches("event_id", catalog.UUID_PATTERN),
        InSet("event_type", (event_type,)),
        Parses("timestamp", ceiling),
        AtLeast("schema_version", 1),
        *domain[event_type],
    ]


def contract_check(
    event_type: str, events: DataFrame, mart: Mart, as_of: datetime | Column | None = None
) -> DataFrame:
    """Contract report of a typed batch; the batch must have exactly the contract's columns."""
    expected = {name: kind for name, kind in catalog.fields(event_type)}
    if dict(events.dtypes) != expected:
        raise QualityError(f"{event_type}: columns are {dict(events.dtypes)}, want {expected}")
    return check(event_type, events, contract(event_type, as_of), mart)


# --- Audits ----------------------------------------------------------------------------------

FACT_SUBJECTS = {
    "fact_recharges": "subscriber_key",
    "fact_bundle_sales": "subscriber_key",
    "fact_calls": "caller_key",
    "fact_sms": "sender_key",
    "fact_data_usage": "subscriber_key",
}


def orphan_calls(mart: Mart) -> DataFrame:
    """Number of calls whose caller or tower is in no dimension.

    Calls are counted per key pair first, so neither join ships a hot caller row by row.
    """
    pairs = mart["fact_calls"].groupBy("caller_key", "tower_key").agg(F.count("*").alias("n"))
    callers = mart["dim_subscriber"].select(
        F.col("subscriber_key").alias("caller_key"), F.lit(True).alias("has_caller")
    )
    towers = mart["dim_tower"].select("tower_key", F.lit(True).alias("has_tower"))
    lost = F.col("has_caller").isNull() | F.col("has_tower").isNull()
    return (
        pairs.join(callers, "caller_key", "left")
        .join(towers, "tower_key", "left")
        .agg(F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphans"))
    )


def duplicate_events(mart: Mart) -> DataFrame:
    """Surplus rows per fact table: count minus distinct event ids."""
    parts = [
        mart[table].agg(
            F.lit(table).alias("table_name"),
            (F.count("*") - F.count_distinct("event_id")).alias("duplicates"),
        )
        for table in FACT_SUBJECTS
    ]
    return reduce(DataFrame.unionByName, parts)


def fact_total(mart: Mart) -> DataFrame:
    """Rows over all fact tables."""
    parts = [mart[table].agg(F.count("*").alias("n")) for table in FACT_SUBJECTS]
    return reduce(DataFrame.unionByName, parts).agg(F.sum("n").alias("total_rows"))


def rejection_reasons(mart: Mart) -> DataFrame:
    return mart["dlq_records"].select("rejection_reason").distinct()


ROLLUP_KEYS = {
    "agg_revenue_minute": ["minute", "province", "revenue_type"],
    "agg_calls_minute": ["minute", "tower_key"],
    "agg_data_minute": ["minute", "tower_key", "technology"],
    "agg_dlq_minute": ["minute", "source_topic", "rejection_reason"],
}


# Tables whose every column is mandatory, and natural keys of the tables that have no suite.
REQUIRED_TABLES = [*FACT_SUBJECTS, "dim_subscriber", "dlq_records", "tower_status_current"]
NATURAL_KEYS = {
    "dim_tower": "tower_id",
    "dim_bundle": "bundle_code",
    "dim_date": "full_date",
    "dlq_records": "event_id",
}
_BOOKKEEPING = {"date_key", "batch_id", "slot", "version"}


def constraints(mart: Mart) -> DataFrame:
    """Table constraints a file store does not enforce: mandatory columns, natural keys, calendar
    keys, rollup primary keys."""
    parts = []
    for table in REQUIRED_TABLES:
        required = [NotNull(c) for c in mart[table].columns if c not in _BOOKKEEPING]
        parts.append(_value_checks(table, mart[table], required))
    keyed: dict[str, list[tuple[Expectation, Column]]] = {}
    for table, column in NATURAL_KEYS.items():
        keyed.setdefault(table, []).append((Unique(column), F.col(column)))
    for table in FACT_SUBJECTS:
        keyed.setdefault(table, []).append((References("date_key", "dim_date", "date_key"), F.col("date_key")))
    for table, columns in ROLLUP_KEYS.items():
        # One text per key that no other key can have, null parts included.
        key = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        keyed.setdefault(table, []).append((Unique("primary_key"), key))
    parts += [_key_checks(table, mart[table], checks, mart) for table, checks in keyed.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("success", F.col("unexpected") == 0)
