import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from coursepulse.model import ENGAGEMENT_WEIGHTS, INTERACTION_TYPES
from coursepulse.operators import popularity as pop
from helpers import at, interactions, rows_of

H10, H11 = at("2024-01-01 10:00:00"), at("2024-01-01 11:00:00")


def test_hourly_rows(spark):
    rows = interactions(spark, [
        ("a", "C", "course_viewed", "2024-01-01 10:00:00"),
        ("a", "C", "course_completed", "2024-01-01 10:30:00"),
        ("b", "C", "video_watched", "2024-01-01 10:59:59.999"),
        ("b", "C", "course_started", "2024-01-01 11:00:00"),
        ("b", "D", None, "2024-01-01 11:10:00"),
    ])
    assert rows_of(pop.popularity(rows)) == sorted([
        ("C", H10, at("2024-01-01 10:59:59.999"), 2, 8, 10),
        ("C", H11, H11, 1, 3, 4),
        ("D", H11, at("2024-01-01 11:10:00"), 1, 0, 1),
    ], key=str)


def test_nulls(spark):
    """No time: no window. No student: scores, but is nobody. No course: a group of its own."""
    rows = interactions(spark, [
        ("a", "C", "course_viewed", None),
        (None, "C", "course_viewed", "2024-01-01 10:00:00"),
        ("a", None, "course_viewed", "2024-01-01 10:00:00"),
    ])
    for exact in (True, False):
        assert rows_of(pop.popularity(rows, exact=exact)) == sorted([
            ("C", H10, H10, 0, 1, 1), (None, H10, H10, 1, 1, 2)], key=str)


@pytest.mark.parametrize("exact", [True, False])
def test_random_feed_with_a_hot_course(spark, exact):
    chance = random.Random(7)
    start = datetime(2024, 1, 1)
    feed = [(
        f"s{chance.randrange(40)}",
        "HOT" if chance.random() < 0.4 else f"c{chance.randrange(5)}",
        chance.choice(INTERACTION_TYPES),
        (start + timedelta(seconds=chance.randrange(4 * 3600))).isoformat(" "),
    ) for _ in range(3000)]
    students, score, last = defaultdict(set), defaultdict(int), {}
    for student, course, kind, time in feed:
        key = (course, at(time).replace(minute=0, second=0))
        students[key].add(student)
        score[key] += ENGAGEMENT_WEIGHTS.get(kind, 0)
        last[key] = max(last.get(key, at(time)), at(time))
    got = {(r.course_code, r.window_start): r
           for r in pop.popularity(interactions(spark, feed), exact=exact).collect()}
    assert set(got) == set(students)
    for key, row in got.items():
        wanted = len(students[key])
        allowed = 0 if exact else max(1, 0.15 * wanted)
        assert abs(row.active_users - wanted) <= allowed
        assert (row.timestamp, row.engagement_score) == (last[key], score[key])
        assert row.total_popularity == row.active_users + row.engagement_score


def test_sums_beyond_int(spark):
    rows = interactions(spark, [("a", "C", "big", "2024-01-01 10:00:00"),
                                ("b", "C", "big", "2024-01-01 10:00:00")])
    heavy = {"big": 2_000_000_000}
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        pop.popularity(rows, weights=heavy).collect()
    wide = pop.popularity(rows, weights=heavy, counter_type="bigint").first()
    assert wide.total_popularity == 4_000_000_002


def test_current_is_the_latest_window(spark):
    rows = interactions(spark, [
        ("a", "C", "course_completed", "2024-01-01 10:00:00"),
        ("a", "C", "course_viewed", "2024-01-01 11:00:00"),
        ("a", "D", "course_viewed", "2024-01-01 10:00:00")])
    current = pop.published(pop.current_popularity(pop.popularity(rows)))
    assert current.columns == [
        "course_code", "timestamp", "active_users", "engagement_score", "total_popularity"]
    assert rows_of(current) == [("C", H11, 1, 1, 2), ("D", H10, 1, 1, 2)]


def test_ranking_and_top(spark):
    rows = interactions(spark, [
        ("a", "B", "course_viewed", "2024-01-01 10:00:00"),
        ("a", "A", "course_viewed", "2024-01-01 10:00:00"),
        ("a", "C", "course_completed", "2024-01-01 10:00:00")])
    windows = pop.popularity(rows)
    assert [r.course_code for r in pop.ranked(windows).collect()] == ["C", "A", "B"]
    assert [r.course_code for r in pop.top_courses(windows, 2).collect()] == ["C", "A"]


def test_category_counts_a_student_once(spark):
    rows = interactions(spark, [
        ("a", "CS1", "course_viewed", "2024-01-01 10:00:00"),
        ("a", "MA1", "course_viewed", "2024-01-01 10:10:00"),
        ("a", "PE1", "course_viewed", "2024-01-01 10:20:00")])
    got = {r.category: r.active_users for r in pop.category_popularity(rows).collect()}
    assert got == {"technical": 1, "arts": 1}
