"""From message values to flat, usable interactions, and the rows that did not make it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse import model
from coursepulse.functions.wire import decode_event, encode_event

#: Message-envelope columns worth keeping: they order two writes of the same key.
ENVELOPE = {
    "timestamp": "ingest_time",
    "partition": "ingest_partition",
    "offset": "ingest_offset",
}

#: Where the text of a record goes that doesn't fit the schema.
CORRUPT = _CORRUPT = "_corrupt"


def encode(interactions: DataFrame) -> DataFrame:
    """One ``value`` column with the JSON form of each interaction."""
    return interactions.select(encode_event().alias("value"))


def flatten(events: DataFrame, *extra: str | Column) -> DataFrame:
    """Lift ``location`` to ``location_country`` / ``location_city``."""
    return events.select(
        *[name for name in model.EVENT_SCHEMA.fieldNames() if name != "location"],
        F.col("location.country").alias("location_country"),
        F.col("location.city").alias("location_city"),
        *extra,
    )


def _expanded(event: Column) -> Column:
    """The fields of a parsed event as columns, one row per event.

    As a generator the parse stays below later filters: the optimizer would push a filter on a
    struct field through a projection and parse every message a second time to evaluate it.
    """
    return F.inline(F.array(event))


def decode(
    messages: DataFrame,
    value: str = "value",
    carry: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parse message values into flat interactions, one per message, bad ones as nulls.

    ``carry`` maps envelope columns to the names they keep beside the interaction.
    """
    carry = carry or {}
    events = messages.select(
        *[F.col(source).alias(target) for source, target in carry.items()],
        _expanded(decode_event(F.col(value))),
    )
    return flatten(events, *carry.values())


def identified(interactions: DataFrame) -> DataFrame:
    """Only interactions of a known student; unparseable messages drop out here too."""
    return interactions.filter(F.col("student_id").isNotNull())


def interactions_from(messages: DataFrame, value: str = "value") -> DataFrame:
    """Usable interactions of a message stream, with the envelope columns the source offers."""
    present = {name: alias for name, alias in ENVELOPE.items() if name in messages.columns}
    return identified(decode(messages, value, present))


def unusable(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that :func:`identified` drops, with the original text and the reason:
    ``null_payload``; ``malformed`` (no JSON object); ``ill_typed`` (an object with a field of
    another type, and no student); ``no_student``."""
    parsed = messages.select(
        F.col(value).cast("string").alias("payload"),
        _expanded(decode_event(F.col(value), _CORRUPT)),
    )
    reason = (
        F.when(F.col("payload").isNull(), F.lit("null_payload"))
        .otherwise(_reason())
    )
    return parsed.filter(F.col("student_id").isNull()).select(
        reason.alias("reason"), "payload")


def _reason() -> Column:
    text = F.col(_CORRUPT)
    is_object = text.rlike(r"^\s*\{") & F.try_parse_json(text).isNotNull()
    return (F.when(text.isNull(), F.lit("no_student"))
            .when(is_object, F.lit("ill_typed")).otherwise(F.lit("malformed")))


def unusable_events(events: DataFrame) -> DataFrame:
    """The same of flat interactions that carry the text of records which don't fit in ``_corrupt``;
    those that do fit are given as JSON again."""
    return events.filter(F.col("student_id").isNull()).select(
        _reason().alias("reason"), F.coalesce(_CORRUPT, encode_event()).alias("payload"))


def field_faults(messages: DataFrame, value: str = "value") -> DataFrame:
    """``student_id, field, expected, found, reason, text``: a row per field of a usable message that was
    given but became null, which :func:`interactions_from` does without a trace.

    The message is read once more as a variant, which keeps whatever it holds: ``found`` is the type
    and ``text`` the value as given. ``reason`` is ``no_time`` (text that is no time), ``out_of_range`` (a
    number that the type has no room for, like a fraction) or ``ill_typed`` (a value of another kind).
    Missing fields and explicit nulls are no faults, and neither is what :func:`unusable` returns.
    """
    parsed = messages.select(F.inline(F.array(F.struct(
        decode_event(F.col(value)).alias("event"),
        F.try_parse_json(F.col(value).cast("string")).alias("given")))))
    kept = parsed.filter(F.col("event.student_id").isNotNull())
    found = F.array(*[_fault(path, kind) for path, kind in _leaves(model.EVENT_SCHEMA)])
    return kept.select(F.col("event.student_id").alias("student_id"),
                       F.inline(F.filter(found, lambda fault: fault["reason"].isNotNull())))


def _leaves(schema: T.StructType, above: str = "") -> list[tuple[str, T.DataType]]:
    """Paths and types of all fields, structs before what they hold."""
    found = []
    for field in schema.fields:
        path = f"{above}{field.name}"
        found.append((path, field.dataType))
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, f"{path}.")
    return found


def _fault(path: str, kind: T.DataType) -> Column:
    given = F.try_variant_get("given", f"$.{path}", "variant")
    found = F.schema_of_variant(given)
    lost = given.isNotNull() & ~F.is_variant_null(given) & F.col(f"event.{path}").isNull()
    reason = F.lit("ill_typed")
    if isinstance(kind, T.TimestampType):
        reason = F.when(found == "STRING", F.lit("no_time")).otherwise(reason)
    if isinstance(kind, T.NumericType):
        number = found.isin("BIGINT", "DOUBLE", "FLOAT") | found.startswith("DECIMAL")
        reason = F.when(number, F.lit("out_of_range")).otherwise(reason)
    expected = "object" if isinstance(kind, T.StructType) else kind.simpleString()
    return F.struct(
        F.lit(path).alias("field"), F.lit(expected).alias("expected"), found.alias("found"),
        F.when(lost, reason).alias("reason"), _text_of(given).alias("text"))


def _text_of(given: Column) -> Column:
    """A variant as text: a string as it is, anything else as JSON."""
    return F.coalesce(F.try_variant_get(given, "$", "string"), F.to_json(given))


def recent(
    interactions: DataFrame,
    as_of: Column | None = None,
    interval: str = "1 hour",
) -> DataFrame:
    """Interactions at or after ``as_of - interval`` (``as_of`` defaults to now)."""
    as_of = F.current_timestamp() if as_of is None else as_of
    return interactions.filter(F.col("timestamp") >= as_of - F.expr(f"INTERVAL {interval}"))
