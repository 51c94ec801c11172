"""Physical plans: what reaches the scan, how often rows are shuffled, and by what."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from coursepulse.operators import popularity as pop
from coursepulse.sources import events as ev
from helpers import at

QUERIES = entry.queries()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return re.findall(r"Exchange (\w+\([^)]*\)|\w+)", re.sub(r"#\d+L?", "", plan))


def test_popularity_shuffles_by_student_then_by_window(spark, sf_dir):
    plan = plan_of(QUERIES["course_popularity_hourly"](spark, sf_dir))
    assert exchanges(plan) == [
        "hashpartitioning(course_code, window, 8)",
        "hashpartitioning(course_code, window, student_id, 8)"]
    assert plan.count("partial_max") == 2  # both shuffles carry map-side partial results


def test_popularity_reads_only_its_columns(spark, sf_dir):
    plan = plan_of(QUERIES["course_popularity_hourly"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint,event_type:string,props:string>" in plan


def test_approximate_popularity_shuffles_once(spark, sf_dir):
    assert len(exchanges(plan_of(QUERIES["course_popularity_approx"](spark, sf_dir)))) == 1


def test_recent_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["recent_interactions"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts,2024-01-29 23:00:00.0)" in plan and not exchanges(plan)


def test_time_filter_below_popularity_reaches_the_scan(spark, sf_dir):
    rows = ev.lift(ev.read_events(spark, sf_dir)).filter(
        F.col("timestamp") < F.lit(at("2024-01-02 00:00:00")))
    assert "LessThan(ts,2024-01-02" in plan_of(pop.popularity(rows))


def test_parsing_is_map_only(spark, sf_dir):
    plan = plan_of(QUERIES["valid_interactions"](spark, sf_dir))
    assert not [e for e in exchanges(plan) if "partitioning" in e or "Single" in e]
    assert plan.count("BroadcastExchange") == 1  # the country lookup, 25 rows


def test_quality_report_is_one_pass(spark, sf_dir):
    plan = plan_of(QUERIES["interaction_quality"](spark, sf_dir))
    assert exchanges(plan) == ["SinglePartition"] and plan.count("FileScan") == 1
    assert "partial_count" in plan  # one row per task reaches the single partition


def test_top_courses_needs_no_sort(spark, sf_dir):
    plan = plan_of(QUERIES["top_courses"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", [
    "parse_interactions", "valid_interactions", "course_popularity_hourly",
    "category_popularity_hourly", "interaction_counts", "interaction_log_latest",
    "cohort_category_affinity", "daypart_profile", "interaction_quality",
    "recommendation_assembly"])
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("Python", "Cartesian", "NestedLoop", "ArrowEval"):
        assert bad not in plan


def test_labels_join_without_broadcast_when_they_are_big(spark, sf_dir):
    """Beyond the threshold the joins shuffle both sides, where skewed keys can be split."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = QUERIES["indexed_pairs"](spark, sf_dir)
        plan = plan_of(frame)
        assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan
        shuffled = sorted(map(tuple, frame.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled == sorted(map(tuple, QUERIES["indexed_pairs"](spark, sf_dir).collect()))


def test_messages_are_parsed_once(spark, sf_dir):
    """The filter on a parsed field must not repeat the parse below it."""
    plan = plan_of(QUERIES["valid_interactions"](spark, sf_dir))
    parse = "from_json(StructField(student_id"
    assert plan.count(parse) == plan.count(f"inline(array({parse}") == 1
