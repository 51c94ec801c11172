from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coursepulse import functions as fn
from coursepulse import model
from helpers import at


def column(spark, values, name, kind, expression):
    frame = spark.createDataFrame([(v,) for v in values], f"{name} {kind}")
    return [r[0] for r in frame.select(expression).collect()]


def test_score(spark):
    kinds = ["course_viewed", "course_started", "course_completed", "video_watched", None]
    assert column(spark, kinds, "interaction_type", "string", fn.engagement_score()) == [
        1, 3, 7, 0, 0]


def test_score_with_other_weights(spark):
    got = column(spark, ["quiz_completed", "course_viewed"], "interaction_type", "string",
                 fn.engagement_score(weights={"quiz_completed": 2}))
    assert got == [2, 0]
    assert column(spark, ["x"], "interaction_type", "string",
                  fn.engagement_score(weights={})) == [0]


def test_every_prefix_has_a_category():
    listed = [p for prefixes in model.COURSE_CATEGORIES.values() for p in prefixes]
    assert sorted(listed) == sorted(model.COURSE_PREFIXES)
    assert len(model.INTERACTION_TYPES) == 29


def test_category(spark):
    codes = ["CS101", "PH200", "PS300", "PE400", "ZZ500", "C", "", None]
    assert column(spark, codes, "course_code", "string", fn.course_category()) == [
        "technical", "humanities", "science", "arts", "others", "others", "others", None]


def test_category_first_match_wins_over_prefix_lengths(spark):
    got = column(spark, ["MAT1", "MA1", "M1"], "course_code", "string", fn.course_category(
        categories={"long": ["MAT"], "short": ["M", "MA"]}, other="none"))
    assert got == ["long", "short", "short"]


def test_cohort(spark):
    ids = ["S10002", "S10004", "S10008", "S10001", "S", "Sxyz", None]
    assert column(spark, ids, "student_id", "string", fn.student_cohort()) == [
        "technical", "humanities", "technical", "uniform", None, None, None]


def test_daypart(spark):
    clocks = ["17:00:00", "22:00:00", "22:00:01", "08:00:00", "16:00:00", "16:30:00", "23:00:00",
              "22:00:00.5"]
    times = [at(f"2024-03-01 {c}") for c in clocks] + [None]
    assert column(spark, times, "timestamp", "timestamp", fn.daypart()) == [
        "evening", "evening", "other", "daytime", "daytime", "other", "other", "evening", None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.integers(0, 86399), min_size=1, max_size=200))
def test_daypart_any_second(spark, seconds):
    midnight = datetime(2024, 1, 1)
    got = column(spark, [midnight + timedelta(seconds=s) for s in seconds], "timestamp",
                 "timestamp", fn.daypart())

    def expected(s):
        if 17 * 3600 <= s <= 22 * 3600:
            return "evening"
        return "daytime" if 8 * 3600 <= s <= 16 * 3600 else "other"
    assert got == [expected(s) for s in seconds]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.integers(0, 10**7), min_size=1, max_size=200))
def test_cohort_any_number(spark, numbers):
    got = column(spark, [f"S{n}" for n in numbers], "student_id", "string", fn.student_cohort())
    assert got == ["technical" if n % 3 == 0 else "humanities" if n % 4 == 0 else "uniform"
                   for n in numbers]


def test_columns_stay_native(spark):
    plan = spark.range(1).select(
        F.lit("CS1").alias("course_code"), F.lit("S1").alias("student_id"),
        F.lit("x").alias("interaction_type"), F.current_timestamp().alias("timestamp"),
    ).select(fn.course_category(), fn.student_cohort(), fn.engagement_score(), fn.daypart())
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
