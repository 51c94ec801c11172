"""The JSON wire form of an interaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse import model


def wire_columns() -> list[Column]:
    """A flat interaction re-nested the way it is published, second-precision local time."""
    return [
        F.col("student_id"),
        F.col("course_code"),
        F.col("interaction_type"),
        F.date_format("timestamp", model.WIRE_TIMESTAMP_FORMAT).alias("timestamp"),
        F.col("duration"),
        F.struct(
            F.col("location_country").alias("country"),
            F.col("location_city").alias("city"),
        ).alias("location"),
    ]


def encode_event() -> Column:
    """JSON text of a flat interaction; missing values are written as explicit nulls."""
    return F.to_json(F.struct(*wire_columns()), {"ignoreNullFields": "false"})


def decode_event(value: Column, corrupt_field: str | None = None) -> Column:
    """Struct parsed from a message value (text or bytes).

    Text that is not one JSON object becomes an all-null struct; a field that does not fit its
    type becomes null on its own. ``corrupt_field`` adds a field that holds the offending text.
    """
    schema, options = model.EVENT_SCHEMA, {"mode": "PERMISSIVE"}
    if corrupt_field:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_field, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_field
    return F.from_json(value.cast("string"), schema, options)
