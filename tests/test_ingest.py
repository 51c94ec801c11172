import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from coursepulse.operators import ingest
from coursepulse.sinks.external import messages as outgoing
from helpers import at, event, interactions, messages, rows_of

VALID = json.dumps(event("S1", "CS1", "course_viewed", "2024-01-01 17:00:00"))
CASES = [
    # value, (student, course, timestamp, duration), kept, reason
    (VALID, ("S1", "CS1", at("2024-01-01 17:00:00"), None), True, None),
    ("not json", (None,) * 4, False, "malformed"),
    (None, (None,) * 4, False, "null_payload"),
    ('[{"student_id":"S3"},{"student_id":"S4"}]', (None,) * 4, False, "malformed"),
    ('{"student_id":"S2","timestamp":"garbage","duration":"abc"}',
     ("S2", None, None, None), True, None),
    ('{"course_code":"CS2"}', (None, "CS2", None, None), False, "no_student"),
    ('{"student_id":"S5","duration":1.5}', ("S5", None, None, None), True, None),
    ('{"student_id":5,"timestamp":"2024-01-01"}',
     ("5", None, at("2024-01-01 00:00:00"), None), True, None),
]


@pytest.mark.parametrize("value,fields,kept,reason", CASES)
def test_decode(spark, value, fields, kept, reason):
    feed = messages(spark, [value])
    row = ingest.decode(feed).first()
    assert (row.student_id, row.course_code, row.timestamp, row.duration) == fields
    assert (ingest.interactions_from(feed).count() == 1) == kept
    assert [r.reason for r in ingest.unusable(feed).collect()] == ([] if kept else [reason])


def test_field_faults(spark):
    """Fields that were given and became null, each with what it held."""
    given = [
        VALID, None, "not json", '{"course_code":7}', "[]",
        '{"student_id":"S1","timestamp":"soon","duration":"5"}',
        '{"student_id":"S2","duration":1.5,"course_code":null,"location":"Lima"}',
        '{"student_id":"S3","duration":3000000000,"location":{"country":{"a":1},"city":null}}',
        '{"student_id":"S4","duration":true,"timestamp":17,"other":"x"}',
        '{"student_id":{"id":5},"duration":[1, 2]}',
    ]
    feed = messages(spark, given)
    found = {(r.student_id, r.field, r.reason): (r.expected, r.found, r.text)
             for r in ingest.field_faults(feed).collect()}
    events = {r.student_id: r for r in ingest.interactions_from(feed).collect()}
    assert found["S1", "timestamp", "no_time"] == ("timestamp", "STRING", "soon")
    assert found["S1", "duration", "ill_typed"] == ("int", "STRING", "5")
    assert found["S2", "duration", "out_of_range"][0::2] == ("int", "1.5")
    assert found["S2", "location", "ill_typed"] == ("object", "STRING", "Lima")
    assert found["S3", "duration", "out_of_range"] == ("int", "BIGINT", "3000000000")
    assert found["S4", "duration", "ill_typed"] == ("int", "BOOLEAN", "true")
    assert not any(field == "course_code" or "city" in field for _, field, _ in found)
    flat = {"location": "location_country", "location.country": "location_country"}
    for student, field, _ in found:  # exactly what is null in the interaction
        assert events[student][flat.get(field, field)] is None
    assert ingest.field_faults(messages(spark, [VALID])).count() == 0


def test_no_message_is_lost(spark):
    feed = messages(spark, [case[0] for case in CASES])
    assert ingest.interactions_from(feed).count() + ingest.unusable(feed).count() == len(CASES)


def test_unusable_keeps_the_whole_text(spark):
    long = "x" * 100_000
    assert ingest.unusable(messages(spark, [long])).first().payload == long


def test_location_is_flattened(spark):
    row = ingest.decode(messages(spark, [VALID])).first()
    assert (row.location_country, row.location_city) == ("PERU", "Lima")
    assert "location" not in row.asDict()


def test_text_values_are_accepted(spark):
    feed = spark.createDataFrame([(VALID,)], "value string")
    assert ingest.interactions_from(feed).first().student_id == "S1"


def test_encoding_matches_the_wire(spark):
    rows = interactions(spark, [("S1", "CS1", "course_viewed", "2024-01-01 17:00:00.75")])
    value = ingest.encode(rows).first().value
    assert json.loads(value) == event(
        "S1", "CS1", "course_viewed", "2024-01-01 17:00:00", None, None, None)


def test_round_trip(spark):
    rows = interactions(spark, [
        ("S1", "CS1", "video_watched", "2024-01-01 17:00:00", 60),
        ("S2", None, None, None),
        ("Sé\"\\\n", "CS1", "x", "1999-12-31 23:59:59"),
    ])
    assert rows_of(ingest.decode(ingest.encode(rows))) == rows_of(rows)


def test_messages_are_keyed_by_student(spark):
    row = outgoing(interactions(spark, [("S1", "CS1", "x", "2024-01-01 00:00:00")])).first()
    assert row.key == "S1" and json.loads(row.value)["student_id"] == "S1"


def test_envelope_columns_travel_along(spark):
    feed = spark.createDataFrame(
        [(bytearray(VALID.encode()), 3, 42, at("2024-01-01 17:00:05"))],
        "value binary, partition int, offset bigint, timestamp timestamp")
    row = ingest.interactions_from(feed).first()
    assert (row.ingest_partition, row.ingest_offset, row.ingest_time, row.timestamp) == (
        3, 42, at("2024-01-01 17:00:05"), at("2024-01-01 17:00:00"))


def test_recent_includes_the_bound_and_drops_null_times(spark):
    rows = interactions(spark, [
        ("a", "C", "x", "2024-01-01 10:00:00"), ("b", "C", "x", "2024-01-01 09:59:59"),
        ("c", "C", "x", "2024-01-01 12:00:00"), ("d", "C", "x", None)])
    as_of = F.lit(at("2024-01-01 11:00:00"))
    assert [r.student_id for r in ingest.recent(rows, as_of).collect()] == ["a", "c"]
    assert [r.student_id for r in ingest.recent(rows, as_of, "10 minutes").collect()] == ["c"]


def test_recent_defaults_to_now(spark):
    now = datetime.now(UTC).replace(tzinfo=None)
    rows = interactions(spark, [
        ("a", "C", "x", (now - timedelta(minutes=30)).isoformat(" ")),
        ("b", "C", "x", (now - timedelta(hours=3)).isoformat(" "))])
    assert [r.student_id for r in ingest.recent(rows).collect()] == ["a"]
