"""Sketches that add up."""

from pyspark.sql import functions as F

from coursepulse.functions import course_category
from coursepulse.operators import popularity as pop
from coursepulse.operators import sketches
from helpers import interactions, rows_of


def many(spark, students=20_000):
    return spark.range(3 * students).select(
        F.concat(F.lit("S"), F.col("id") % students).alias("student_id"),
        F.when(F.col("id") % 3 == 0, F.lit("CS101")).otherwise(F.lit("HI205")).alias("course_code"),
        F.lit("course_started").alias("interaction_type"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 29 % (6 * 86400)).alias("timestamp"))


def test_merged_is_the_sketch_over_all_events(spark):
    rows = many(spark)
    hourly = sketches.hourly_sketches(rows)
    for window in ("1 day", "7 days"):
        merged = sketches.merged(hourly, window)
        direct = sketches.hourly_sketches(rows, window).withColumnRenamed("students", "direct")
        by = ["course_code", "window_start"]
        same = merged.join(direct.select(*by, "direct"), by).select(
            sketches.same_students("students", "direct"))
        assert same.count() == merged.count() and all(r[0] for r in same.collect())
        exact = pop.popularity(rows, window)
        both = merged.select("course_code", "window_start", sketches.active_users().alias("users"),
                             "engagement_score", "timestamp").join(
            exact.select("course_code", "window_start", "active_users",
                         F.col("engagement_score").alias("score"), F.col("timestamp").alias("last")),
            ["course_code", "window_start"], "full").collect()
        assert all(abs(r.users - r.active_users) <= 0.06 * r.active_users for r in both)
        assert all(r.engagement_score == r.score and r.timestamp == r["last"] for r in both)
        assert max(r.active_users for r in both) > 1500


def test_students_of_several_hours_and_courses_count_once(spark):
    rows = interactions(spark, [
        ("a", "CS101", "course_viewed", "2024-01-01 10:00:00"),
        ("a", "CS101", "course_started", "2024-01-01 11:00:00"),
        ("a", "CS102", "course_viewed", "2024-01-01 12:00:00"),
        ("b", "CS102", "course_viewed", "2024-01-02 12:00:00"),
        (None, "CS101", "course_viewed", "2024-01-03 12:00:00"),
        ("c", "CS101", "course_viewed", None),
    ])
    hourly = sketches.hourly_sketches(rows).withColumn("category", course_category())
    daily = sketches.estimated(sketches.merged(hourly, "1 day", ("category",)), ("category",))
    assert [r.active_users for r in daily.orderBy("window_start").collect()] == [1, 1, 0]
    week = sketches.estimated(sketches.merged(hourly, "7 days", ()), ())
    assert [r.active_users for r in week.collect()] == [2]
    assert rows_of(sketches.estimated(sketches.merged(hourly, "1 day"))) == rows_of(
        pop.popularity(rows, "1 day"))


def test_partial_sketches_before_the_shuffle(spark):
    plan = sketches.merged(sketches.hourly_sketches(many(spark)), "1 day")._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("partial_hll") == 2
