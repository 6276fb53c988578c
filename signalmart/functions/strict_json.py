"""Strict reading of JSON text as Catalyst expressions: exact types, no trailing text, key order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmart import catalog

# Type names the document schema shows for each contract kind; a double field also takes integers.
_SHAPES = {
    "string": "STRING",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": r"(BIGINT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\))",
}


def fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever is done with it later.

    Filters are pushed through projections by copying their expressions; a generated column stops
    that, so an expensive verdict is not evaluated in the filter and again in the result.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_document(df: DataFrame, raw: str = "raw", out: str = "document") -> DataFrame:
    """Add the VARIANT of `raw`; NULL unless the text is exactly one JSON document.

    The built-in parser stops after the first complete document, so the text is placed in an
    array in front of its own hash: the hash is only found in second place when nothing but one
    document stands before it.
    """
    seal = F.xxhash64(raw)
    boxed = F.try_parse_json(
        F.concat(F.lit("["), F.col(raw), F.lit(","), seal.cast("string"), F.lit("]"))
    )
    sealed = F.try_variant_get("_boxed", "$[1]", "bigint") == seal
    document = F.when(sealed, F.variant_get("_boxed", "$[0]", "variant"))
    return fixed(df.withColumn("_boxed", boxed), out, document).drop("_boxed")


def with_payload(df: DataFrame, event_types: tuple[str, ...], document: str = "document") -> DataFrame:
    """Add one typed column per contract field, taken from the parsed document; a field it lacks is NULL.

    Values are converted where they can be, so they only count for records whose structure was found sound.
    """
    wide = catalog.wide_fields(event_types)
    target = ", ".join(f"`{name}`: {kind}" for name, kind in wide.items())
    columns = {
        (catalog.DECLARED_TYPE if name == "event_type" else name): F.col(f"_payload.{name}")
        for name in wide
    }
    payload = F.try_variant_get(document, "$", f"struct<{target}>")
    return fixed(df, "_payload", payload).withColumns(columns).drop("_payload")


def by_event_type(branches: dict[str, Column], event_type: str = "event_type") -> Column:
    """CASE over the event type, so a row only pays for the checks of its own type."""
    (first, head), *rest = branches.items()
    kind = F.col(event_type)
    return reduce(
        lambda case, item: case.when(kind == item[0], item[1]), rest, F.when(kind == first, head)
    )


def _conforming_shape(event_type: str) -> str:
    """Pattern of the document schema of an event with exactly the contract's fields and types."""
    members = ", ".join(f"{name}: {_SHAPES[kind]}" for name, kind in sorted(catalog.fields(event_type)))
    return rf"^OBJECT<{members}>\z"


def _by_type_literal(event_types: tuple[str, ...], values: dict[str, list[str]]) -> Column:
    pairs = []
    for kind in event_types:
        pairs += [F.lit(kind), F.array(*[F.lit(v) for v in values[kind]])]
    return F.try_element_at(F.create_map(*pairs), F.col("event_type"))


def _field_tags(document: str, names: Column, kinds: Column) -> Column:
    """missing/type tags in contract order; a JSON null is there, but of no contract type."""
    members = F.try_variant_get(document, "$", "map<string, variant>")

    def tag(name: Column, kind: Column) -> Column:
        found = F.schema_of_variant(F.try_element_at(members, name))
        number = found.isin("BIGINT", "DOUBLE") | found.startswith("DECIMAL(")
        fits = (F.lower(found) == kind) | ((kind == "double") & number)
        return F.when(found.isNull(), F.concat(F.lit("missing:"), name)).when(
            ~fits, F.concat(F.lit("type:"), name)
        )

    return F.array_compact(F.zip_with(names, kinds, tag))


def _format_tags() -> list[Column]:
    """Value checks on the typed envelope that keep a well-formed event from breaking the load."""
    return [
        F.when(~F.col("event_id").rlike(catalog.UUID_PATTERN), "format:event_id"),
        F.when(F.col(catalog.DECLARED_TYPE) != F.col("event_type"), "value:event_type"),
        F.when(F.col("schema_version") < 1, "value:schema_version"),
    ]


def _conforms(event_types: tuple[str, ...], document: str) -> Column:
    """Whether the whole schema of the document is the one its event type prescribes."""
    shape = F.schema_of_variant(F.col(document))
    return by_event_type({kind: shape.rlike(_conforming_shape(kind)) for kind in event_types})


def _deviations(event_types: tuple[str, ...], raw: str, document: str) -> Column:
    """Tags of a document that does not conform, found field by field."""
    of_fields, surplus = _deviation_parts(event_types, raw, document)
    return F.when(_is_object(document), F.concat(of_fields, surplus)).otherwise(F.array(F.lit("not_an_object")))


def _first_deviation(event_types: tuple[str, ...], raw: str, document: str) -> Column:
    """The first of `_deviations`; the text is looked through for surplus keys only if no field is wrong."""
    of_fields, surplus = _deviation_parts(event_types, raw, document)
    first = F.coalesce(F.get(of_fields, F.lit(0)), F.get(surplus, F.lit(0)))
    return F.when(_is_object(document), first).otherwise("not_an_object")


def _is_object(document: str) -> Column:
    return F.schema_of_variant(F.col(document)).startswith("OBJECT")


def _deviation_parts(event_types: tuple[str, ...], raw: str, document: str) -> tuple[Column, Column]:
    """missing/type tags and unexpected tags of an object."""
    contracts = {kind: catalog.fields(kind) for kind in event_types}
    names = _by_type_literal(event_types, {k: [n for n, _ in f] for k, f in contracts.items()})
    kinds = _by_type_literal(event_types, {k: [t for _, t in f] for k, f in contracts.items()})
    surplus = F.transform(
        F.array_except(F.json_object_keys(raw), names),
        lambda key: F.concat(F.lit("unexpected:"), key),
    )
    return _field_tags(document, names, kinds), surplus


def schema_tags(
    event_types: tuple[str, ...], strict: bool, raw: str = "raw", document: str = "document"
) -> Column:
    """Every structural violation in reporting order, empty when the document conforms, NULL when
    there is no document. Needs `event_type` and, if `strict`, the payload columns.

    A conforming event is recognised by one match of its whole schema; only the others are looked
    at field by field. Value checks are made on conforming events only.
    """
    sound = F.array_compact(F.array(*_format_tags())) if strict else F.array().cast("array<string>")
    return F.when(
        F.col(document).isNotNull(),
        F.when(_conforms(event_types, document), sound).otherwise(
            _deviations(event_types, raw, document)
        ),
    )


def first_schema_tag(
    event_types: tuple[str, ...], strict: bool, raw: str = "raw", document: str = "document"
) -> Column:
    """The first of `schema_tags`, NULL if there is none, without building the list for clean rows."""
    sound = F.coalesce(*_format_tags()) if strict else F.lit(None).cast("string")
    return F.when(_conforms(event_types, document), sound).otherwise(
        _first_deviation(event_types, raw, document)
    )
