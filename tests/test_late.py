"""Late events: kept aside, and their windows counted anew."""

import json

import pytest

from coursepulse.operators import ingest
from coursepulse.operators import popularity as pop
from coursepulse.streaming import (
    LateEvents,
    PopularityStore,
    await_all,
    late_rows,
    start_late_events,
    start_popularity,
)
from helpers import event, interactions, rows_of, write_lines

ONCE = {"availableNow": True}


def seen(student, time, kind="course_viewed", course="C"):
    return event(student, course, kind, time)


class Feed:
    """A growing folder of JSON lines, one file per call of ``add``."""

    def __init__(self, spark, path):
        self.spark, self.path, self.events = spark, path, []

    def add(self, *events):
        write_lines(self.path / f"{len(self.events):04d}.json", events)
        self.events += events

    def stream(self, files=1000):
        source = self.spark.readStream.option("maxFilesPerTrigger", files).text(str(self.path))
        return ingest.interactions_from(source)

    def all(self):
        rows = [(json.dumps(e),) for e in self.events]
        return ingest.interactions_from(self.spark.createDataFrame(rows, "value string"))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


@pytest.mark.parametrize("mode, exact", [
    ("update", True), ("update", False), ("append", True), ("append", False)])
def test_repair_makes_it_what_complete_mode_has(spark, feed, tmp_path, mode, exact):
    store = PopularityStore(spark, f"{tmp_path}/out", mode, exact)
    late = LateEvents(spark, f"{tmp_path}/late", aligned=True)
    runs = [
        [seen("a", "2024-01-01 10:05:00"), seen("b", "2024-01-01 10:06:00", "course_started")],
        [seen("b", "2024-01-03 20:00:00")],
        [seen("c", "2024-01-01 10:10:00"), seen("a", "2024-01-01 10:59:00"),
         seen("c", "2024-01-02 23:59:59", course="D"), seen("d", "2024-01-03 19:30:00")],
        [seen("e", "2024-01-04 10:00:00")],
    ]
    dropped = 0
    for events in runs:
        feed.add(*events)
        popularity = start_popularity(feed.stream(), store, f"{tmp_path}/cp", trigger=ONCE,
                                      state_partitions=2)
        await_all(popularity)
        dropped += late_rows(popularity)
        await_all(start_late_events(feed.stream(), late, f"{tmp_path}/cp-late", ONCE))
    assert sorted(r.timestamp.isoformat() for r in late.events().collect()) == [
        "2024-01-01T10:10:00", "2024-01-01T10:59:00", "2024-01-02T23:59:59"]
    expected = pop.popularity(feed.all(), exact=exact)
    if mode == "append":  # which holds back the last window
        expected = expected.filter("window_start < '2024-01-04'")
    assert rows_of(store.windows()) != rows_of(expected)
    assert late.repair(store, feed.all()) == 2
    assert rows_of(store.windows()) == rows_of(expected)
    assert late.events().count() == 0 and late.repair(store, feed.all()) == 0
    # the stream goes on: late once more, and a window of its own
    feed.add(seen("f", "2024-01-01 10:20:00"), seen("g", "2024-01-04 10:30:00"))
    await_all(start_popularity(feed.stream(), store, f"{tmp_path}/cp", trigger=ONCE, state_partitions=2))
    await_all(start_late_events(feed.stream(), late, f"{tmp_path}/cp-late", ONCE))
    assert late.repair(store, feed.all()) == 1
    expected = pop.popularity(feed.all(), exact=exact)
    if mode == "append":
        expected = expected.filter("window_start < '2024-01-04'")
    assert rows_of(store.windows()) == rows_of(expected)


def test_batches_of_another_cut(spark, feed, tmp_path):
    """The late events are read in one batch, the popularity query went file by file."""
    for number, time in enumerate(["01 10:00", "02 10:00", "01 10:30", "03 10:00", "02 10:30", "01 11:30"]):
        feed.add(seen(f"s{number}", f"2024-01-{time}:00"))
    store = PopularityStore(spark, f"{tmp_path}/out", "update", exact=True)
    await_all(start_popularity(feed.stream(1), store, f"{tmp_path}/cp", trigger=ONCE, state_partitions=2))
    expected = rows_of(pop.popularity(feed.all()))
    assert rows_of(store.windows()) != expected
    late = LateEvents(spark, f"{tmp_path}/late")
    await_all(start_late_events(feed.stream(), late, f"{tmp_path}/cp-late", ONCE))
    late.repair(store, feed.all())
    assert rows_of(store.windows()) == expected


def test_a_repeated_batch_counts_once(spark, tmp_path):
    late = LateEvents(spark, f"{tmp_path}/late", aligned=True)
    first = interactions(spark, [("a", "C", "x", "2024-01-05 10:00:00")])
    second = interactions(spark, [("a", "C", "x", "2024-01-01 10:00:00"), ("b", "C", "x", None)])
    for _ in range(2):
        late.write(first, 0, "w")
    for _ in range(2):
        late.write(second, 1, "w")
    late.write(second, 0, "other/writer")
    assert [r.student_id for r in late.events().collect()] == ["a"]
    late.write(first.limit(0), 2, "w")
    late.write(second, 3, "w")
    assert late.events().count() == 2


def test_windows_far_apart_read_their_days_only(spark, tmp_path):
    late = LateEvents(spark, f"{tmp_path}/late")
    condition = str(late._near([19000, 19001, 19500])._jc)
    assert condition.count("timestamp_seconds") == 4
    assert str(late._near(list(range(0, 1000, 2)))._jc).count("timestamp_seconds") == 2


def test_complete_mode_needs_no_repair(spark, tmp_path):
    rows = interactions(spark, [("a", "C", "x", "2024-01-01 10:00:00")])
    late = LateEvents(spark, f"{tmp_path}/late")
    late.write(rows, 0)
    late.write(interactions(spark, [("a", "C", "x", "2024-01-05 10:00:00")]), 1)
    late.write(rows, 2)
    with pytest.raises(ValueError):
        late.repair(PopularityStore(spark, f"{tmp_path}/out", "complete"), rows)
    assert late.events().count() == 1  # not forgotten
