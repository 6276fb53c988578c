"""Raw records to verdicts: parse, structure, business rules.

Input is the raw contract `(topic, partition, offset, raw)` plus anything else a source carries.
Everything stays one narrow projection; the only joins are the two reference lookups.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart import catalog
from signalmart.functions import strict_json, times
from signalmart.operators import rules as rulebook
from signalmart.operators.rules import RULES, Reference, Rule

RAW_COLUMNS = ("topic", "partition", "offset", "raw")


def decode(records: DataFrame) -> DataFrame:
    """Broker records (key, value, topic, partition, offset, ...) to the raw contract."""
    return records.select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("raw")
    )


def with_event_type(raw: DataFrame) -> DataFrame:
    """Keep records of contract topics and add the event type their topic carries."""
    return raw.where(F.col("topic").isin(*catalog.TOPICS)).withColumn(
        "event_type", catalog.event_type_of(F.col("topic"))
    )


def parsed(raw: DataFrame, event_types: tuple[str, ...] = catalog.EVENT_TYPES) -> DataFrame:
    """Typed records: raw columns, `event_type`, `document`, every payload column, event time."""
    typed = strict_json.with_payload(strict_json.with_document(raw), event_types)
    return typed.withColumns(
        {
            "event_id": F.lower("event_id"),  # upper-case identifiers are the same identifiers
            "event_timestamp": times.iso_timestamp(F.col("timestamp")),
        }
    )


def schema_violations_of(raw: DataFrame, strict: bool = True) -> DataFrame:
    """All structural violations per record, `violations` as an ordered array; NULL if unparsed."""
    typed = parsed(with_event_type(raw))
    return strict_json.fixed(
        typed, "violations", strict_json.schema_tags(catalog.EVENT_TYPES, strict)
    )


def rule_violations_of(
    raw: DataFrame,
    reference: Reference,
    as_of: datetime | Column | None = None,
    rules: dict[str, tuple[Rule, ...]] = RULES,
) -> DataFrame:
    """All violated rules per record, evaluated on whatever payload is there."""
    clock = times.as_time(as_of)
    hits = {kind: rulebook.violated(rules[kind], clock) for kind in catalog.EVENT_TYPES}
    typed = rulebook.with_reference(parsed(with_event_type(raw)), reference)
    return typed.withColumn("violations", strict_json.by_event_type(hits))


def _prefixed(prefix: str, tag: Column) -> Column:
    """Reason text of a tag, whole; NULL stays NULL."""
    return F.concat(F.lit(prefix), tag)


def validate(
    raw: DataFrame,
    reference: Reference,
    as_of: datetime | Column | None = None,
    strict: bool = True,
    rules: dict[str, tuple[Rule, ...]] = RULES,
) -> DataFrame:
    """Typed records with `reason`: NULL for an accepted event, else why it was rejected.

    `strict` adds the identifier, declared-type and version checks of the batch contract, without
    which a well-typed but unusable event would reach the tables.
    """
    clock = times.as_time(as_of)
    business = {kind: rulebook.first_violated(rules[kind], clock) for kind in catalog.EVENT_TYPES}
    structure = strict_json.first_schema_tag(catalog.EVENT_TYPES, strict)
    typed = (
        parsed(with_event_type(raw))
        .withColumn(
            "_structure",
            F.when(F.col("document").isNull(), "PARSE_ERROR").otherwise(
                _prefixed("SCHEMA_VIOLATION:", structure)
            ),
        )
        .drop("document")
    )
    reason = F.coalesce(
        F.col("_structure"), _prefixed("RULE_VIOLATION:", strict_json.by_event_type(business))
    )
    looked_up = strict_json.fixed(rulebook.with_reference(typed, reference), "reason", reason)
    return looked_up.drop("_structure", "tower_known", "catalog_price")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNull()).drop("reason")


def rejected(validated: DataFrame) -> DataFrame:
    """Rejects in the shape the dead-letter envelope is built from."""
    return validated.where(F.col("reason").isNotNull()).select(*RAW_COLUMNS, "reason")


def events_of(events: DataFrame, event_type: str) -> DataFrame:
    """The typed events of one type, exactly the contract's columns, as stored in the lake.

    The type is that of the topic. Named as well, the topic is a filter that passes below deduplication and
    parsing, which treat each topic for itself.
    """
    columns = [
        F.col(catalog.DECLARED_TYPE if name == "event_type" else name).alias(name)
        for name, _ in catalog.fields(event_type)
    ]
    of_type = F.col("event_type") == event_type
    if "topic" in events.columns:
        of_type &= F.col("topic") == next(topic for topic, kind in catalog.TOPICS.items() if kind == event_type)
    return events.where(of_type).select(*columns)


def batch_counts(resolved: DataFrame, rejects: DataFrame) -> DataFrame:
    """Accepted and rejected records per event type.

    Accepted are the events that end in the tables: first of their id, of a known subscriber where they refer
    to one. Rejected is every record that becomes a dead letter. A repeated event is neither.
    """
    accepted = resolved.where(F.col("subject_id").isNull() | F.col("subject_key").isNotNull())
    both = accepted.select("event_type", F.lit(True).alias("accepted")).unionByName(
        rejects.select(catalog.event_type_of(F.col("topic")).alias("event_type"), F.lit(False).alias("accepted"))
    )
    return both.groupBy("event_type", "accepted").agg(F.count("*").alias("n_records"))
