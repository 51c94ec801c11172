"""Counts by day: only days with new files are read."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from coursepulse.operators.counts import interaction_counts
from coursepulse.plans import Tables, recommendation_job
from coursepulse.sinks import DayCounts, land
from coursepulse.sources import read_landed
from helpers import interactions, rows_of


@pytest.fixture
def landing(tmp_path):
    return f"{tmp_path}/landing"


@pytest.fixture
def counts(spark, tmp_path):
    return DayCounts(spark, f"{tmp_path}/counts")


def arrive(spark, landing, *rows):
    land(interactions(spark, rows), landing, by_date=True)


def expected(spark, landing):
    return rows_of(interaction_counts(read_landed(spark, landing).filter("student_id is not null")))


def test_only_changed_days_are_read(spark, landing, counts, monkeypatch):
    assert counts.counts().count() == 0
    arrive(spark, landing, ("a", "C", "x", "2024-01-01 10:00:00"), ("a", "C", "x", "2024-01-02 10:00:00"),
           ("b", "C", None, "2024-01-02 11:00:00"), ("b", "D", "x", None), (None, "D", "x", None))
    none = "__HIVE_DEFAULT_PARTITION__"
    assert counts.update(landing) == ["2024-01-01", "2024-01-02", none]
    assert rows_of(counts.counts()) == expected(spark, landing)
    arrive(spark, landing, ("a", "C", "x", "2024-01-03 10:00:00"))
    read = []
    count = DayCounts._count
    monkeypatch.setattr(DayCounts, "_count", lambda self, rows: read.extend(rows.inputFiles()) or count(self, rows))
    assert counts.update(f"{landing}/") == ["2024-01-03"]
    assert read and all("event_date=2024-01-03" in f for f in read)
    arrive(spark, landing, ("c", "C", "x", "2024-01-01 12:00:00"), ("b", "D", "x", None))
    assert counts.update(landing) == ["2024-01-01", none]
    assert counts.update(landing) == []
    assert rows_of(counts.counts()) == expected(spark, landing)


def test_an_update_that_ends_half_way_is_done_again(spark, landing, counts, monkeypatch):
    from coursepulse.sinks import day_counts

    arrive(spark, landing, ("a", "C", "x", "2024-01-01 10:00:00"), ("a", "C", "x", "2024-01-02 10:00:00"))
    put, done = day_counts.put_text, []

    def fail(*given):
        if done:
            raise RuntimeError
        done.append(put(*given))
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(day_counts, "put_text", fail)
        counts.update(landing)
    assert counts.update(landing) == ["2024-01-02"]
    assert rows_of(counts.counts()) == expected(spark, landing)


def test_a_day_that_is_gone_keeps_its_counts(spark, landing, counts):
    arrive(spark, landing, ("a", "C", "x", "2024-01-01 10:00:00"))
    counts.update(landing)
    before = rows_of(counts.counts())
    for file in Path(landing, "event_date=2024-01-01").iterdir():
        file.unlink()
    arrive(spark, landing, ("b", "C", "x", "2024-01-02 10:00:00"))
    assert counts.update(landing) == ["2024-01-02"]
    assert set(before) < set(rows_of(counts.counts()))


def test_recommendations_from_counts(spark, landing, counts, tmp_path):
    rows = [(f"s{s}", f"C{c}", "x", f"2024-01-0{1 + (s + c) % 3} 10:00:00")
            for s in range(8) for c in range(6) if (s * c) % 3 != 1]
    arrive(spark, landing, *rows)
    counts.update(landing)
    direct = recommendation_job(spark, read_landed(spark, landing), Tables(spark, f"{tmp_path}/t1"), n=3)
    stored = recommendation_job(spark, counts, Tables(spark, f"{tmp_path}/t2"), n=3)
    rounded = [c if c != "rating" else F.round("rating", 4).alias("rating") for c in direct.columns]
    assert rows_of(direct.select(*rounded)) == rows_of(stored.select(*rounded))
