import pytest

from coursepulse.operators import profiles
from helpers import interactions, rows_of


def test_quality_counts_each_breach(spark):
    time = "2024-01-01 10:00:00"
    rows = interactions(spark, [
        ("S10001", "CS1", "video_watched", time, 20),       # fine
        ("S10001", "CS1", "video_watched", time, 7201),     # out of range
        ("S10001", "CS1", "video_watched", time),           # duration missing
        ("S10001", "CS1", "course_viewed", time, 60),       # duration unexpected
        ("S10001", "CS1", None, time, 60),                  # no type, duration unexpected
        ("X1", "CS1", "dancing", time),                     # bad id, unknown type
        (None, None, "course_viewed", None),                # nothing known
    ])
    assert profiles.quality_report(rows).first().asDict() == {
        "interactions": 7, "null_student": 1, "null_course": 1, "null_type": 1,
        "null_timestamp": 1, "malformed_student": 1, "unknown_type": 1, "missing_duration": 1,
        "unexpected_duration": 2, "duration_out_of_range": 1}


def test_cohort_shares(spark):
    rows = interactions(spark, [
        ("S3", "CS1", "x", "2024-01-01 10:00:00"), ("S3", "CS2", "x", "2024-01-01 10:00:00"),
        ("S3", "PE1", "x", "2024-01-01 10:00:00"), ("S4", "HI1", "x", "2024-01-01 10:00:00")])
    assert rows_of(profiles.cohort_affinity(rows)) == [
        ("humanities", "humanities", 1, 1.0),
        ("technical", "arts", 1, pytest.approx(1 / 3)),
        ("technical", "technical", 2, pytest.approx(2 / 3))]


def test_daypart_shares(spark):
    rows = interactions(spark, [
        ("a", "C", "x", f"2024-01-01 {h}:00:00") for h in ("18", "19", "09", "03")])
    assert rows_of(profiles.daypart_profile(rows)) == [
        ("daytime", 1, 0.25), ("evening", 2, 0.5), ("other", 1, 0.25)]
