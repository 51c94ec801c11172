"""Bucketed tables: pruning, joins without a shuffle, last write wins."""

import pytest
from pyspark.sql import functions as F

from coursepulse import model
from coursepulse.sinks import BucketedTable
from helpers import interactions, rows_of


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def events(spark, students=40, days=5, kind="x"):
    return interactions(spark, [
        (f"s{student}", "C", kind, f"2024-01-{day + 1:02d} 10:00:00")
        for student in range(students) for day in range(days)])


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTable(spark, f"{tmp_path}/log", model.INTERACTION_LOGS, buckets=8)


def test_a_lookup_opens_one_bucket(spark, table):
    table.add(events(spark))
    table.add(events(spark, kind="y"))
    for compacted in (False, True):
        if compacted:
            table.compact()
        found = table.lookup("s7")
        assert "SelectedBucketsCount: 1 out of 8" in found._jdf.queryExecution().explainString(
            found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert [(r.student_id, r.timestamp.day, r.interaction_type) for r in found.collect()] == [
            ("s7", day, "y") for day in range(1, 6)]
        assert len({f.rsplit("_", 1)[1][:5] for f in table.rows().inputFiles()}) == 8
    assert table.lookup("s1", "s2").count() == 10 and table.lookup("nobody").count() == 0


def test_settling_and_joins_need_no_exchange(spark, tmp_path, table):
    table.add(events(spark))
    other = BucketedTable(spark, f"{tmp_path}/recs", model.STUDENT_RECOMMENDATIONS, buckets=8)
    other.add(spark.createDataFrame(
        [(f"s{n}", "C", 1.0, None) for n in range(0, 40, 2)], model.STUDENT_RECOMMENDATIONS.schema)
        .withColumn("recommendation_time", F.lit("2024-01-01").cast("timestamp")))
    seen = table.rows().groupBy("student_id").agg(F.max("timestamp").alias("seen"))
    joined = other.rows().hint("merge").join(seen, "student_id")
    assert "Exchange" not in plan_of(joined)
    assert joined.count() == 20


def test_generations(spark, table):
    assert table.rows().count() == 0
    table.compact()
    table.add(events(spark, 3, 1).union(interactions(spark, [(None, "C", "x", "2024-01-01 10:00:00")])))
    before = rows_of(table.rows())
    assert len(before) == 3
    old = table.rows()
    table.compact()
    assert rows_of(table.rows()) == before == rows_of(old)
    table.prune()
    assert len(table._generations()) == 1 and rows_of(table.rows()) == before
    table.replace(events(spark, 1, 1))
    assert table.rows().count() == 1


def test_another_session_finds_the_table(spark, table):
    table.add(events(spark, 4, 2))
    other = spark.newSession()
    again = BucketedTable(other, table.path, model.INTERACTION_LOGS)
    assert "SelectedBucketsCount: 1 out of 8" in again.lookup("s1")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert again.lookup("s1").count() == 2


def test_a_hot_student_is_split_over_files(spark, tmp_path, table):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 500))
        .alias("student_id"), F.sha2(F.col("id").cast("string"), 256).alias("course_code"),
        F.lit("x").alias("interaction_type"), F.timestamp_seconds(F.col("id")).alias("timestamp"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        table.add(rows.repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.lookup("hot").count() == 20_000
    assert len(table.lookup("hot").inputFiles()) >= 1
    assert table.rows().count() == 60_000


def test_by_has_to_be_a_key(spark, tmp_path):
    with pytest.raises(ValueError):
        BucketedTable(spark, f"{tmp_path}/x", model.INTERACTION_LOGS, by="course_code")
