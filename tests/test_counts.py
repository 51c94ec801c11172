import random

from coursepulse.operators import counts
from helpers import at, interactions, rows_of


def test_counts_skip_missing_types_but_keep_the_pair(spark):
    rows = interactions(spark, [
        ("a", "C", "x", "2024-01-01 10:00:00"), ("a", "C", "y", "2024-01-02 10:00:00"),
        ("a", "C", None, "2024-01-03 10:00:00"), ("b", "C", None, "2024-01-01 10:00:00")])
    assert rows_of(counts.interaction_counts(rows)) == [
        ("a", "C", 2, at("2024-01-03 10:00:00")), ("b", "C", 0, at("2024-01-01 10:00:00"))]


def test_last_seen(spark):
    rows = interactions(spark, [
        ("a", "C", "x", "2024-01-01 10:00:00"), ("a", "D", "x", "2024-01-02 10:00:00")])
    assert rows_of(counts.last_seen(counts.interaction_counts(rows))) == [
        ("a", at("2024-01-02 10:00:00"))]


def test_index_order(spark):
    pairs = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "label string")
    got = counts.dense_index(pairs, "label", "i").orderBy("i").collect()
    assert [(r.label, r.i) for r in got] == [("c", 0), ("a", 1), ("b", 2)]


def test_index_over_many_partitions(spark):
    """Most labels tie on one pair; one label holds a third of all pairs."""
    chance = random.Random(3)
    labels = [f"l{n:05d}" for n in range(5000)]
    pairs = labels + ["hot"] * 3000 + chance.sample(labels, 1000)
    chance.shuffle(pairs)
    frame = spark.createDataFrame([(p,) for p in pairs], "label string").repartition(7)
    index = counts.dense_index(frame, "label", "i")
    tally = {}
    for label in pairs:
        tally[label] = tally.get(label, 0) + 1
    wanted = {label: i for i, label in enumerate(sorted(tally, key=lambda k: (-tally[k], k)))}
    assert {r.label: r.i for r in index.collect()} == wanted


def test_index_of_nothing(spark):
    assert counts.dense_index(spark.createDataFrame([], "label string"), "label", "i").count() == 0
