import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from coursepulse.operators.ingest import identified
from coursepulse.plans import Tables, ingest_landed, replay_to_landing
from coursepulse.sinks import land
from coursepulse.sources import read_landed, stream_landed, unusable_landed
from coursepulse.streaming import await_all, start_quarantine
from helpers import at, event, interactions, messages, rows_of

TWO = [event("S1", "CS1", "course_viewed", "2024-01-01 10:00:00"),
       event("S2", "MA1", "video_watched", "2024-01-02 11:00:00", 60)]


def test_array_file_and_line_file(spark, tmp_path):
    (tmp_path / "log_1_a.json").write_text(json.dumps(TWO))
    (tmp_path / "log_2_b.json").write_text("\n".join(json.dumps(e) for e in TWO))
    (tmp_path / "other.json").write_text(json.dumps(TWO))
    rows = read_landed(spark, f"{tmp_path}/log_*")
    assert rows.count() == 4
    assert dict(rows.dtypes)["timestamp"] == "timestamp" and dict(rows.dtypes)["duration"] == "int"
    assert rows.filter("duration = 60 and location_city = 'Lima'").count() == 2


def test_pretty_printed_array(spark, tmp_path):
    (tmp_path / "log.json").write_text(json.dumps(TWO, indent=2))
    assert read_landed(spark, f"{tmp_path}/log.json", multi_line=True).count() == 2


def test_landing_appends_and_reads_back(spark, tmp_path):
    rows = interactions(spark, [("S1", "CS1", "video_watched", "2024-01-01 10:00:00", 5),
                                ("S2", None, None, "2024-01-02 10:00:00")])
    path = f"{tmp_path}/flat"
    land(rows, path)
    land(rows, path)
    assert rows_of(read_landed(spark, path)) == rows_of(rows.union(rows))
    written = "".join(p.read_text() for p in (tmp_path / "flat").glob("*.json"))
    assert '"location":{"country":null,"city":null}' in written


def test_landing_by_date_prunes_folders(spark, tmp_path):
    rows = interactions(spark, [
        (f"S{i}", "CS1", "x", f"2024-01-{1 + i % 5:02d} 10:00:00") for i in range(100)])
    path = f"{tmp_path}/dated"
    land(rows, path, by_date=True, rebalance=True)
    assert rows_of(read_landed(spark, path)) == rows_of(rows)
    some = read_landed(spark, path, since=date(2024, 1, 2), until=date(2024, 1, 3))
    assert {r.timestamp.day for r in some.collect()} == {2, 3} and some.count() == 40
    assert some.columns == rows.columns
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_landed_files_as_a_stream(spark, tmp_path):
    land(interactions(spark, [("S1", "CS1", "x", "2024-01-01 10:00:00")]), f"{tmp_path}/in")
    query = (identified(stream_landed(spark, f"{tmp_path}/in", 1)).writeStream.format("parquet")
             .option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").first().timestamp == at("2024-01-01 10:00:00")


def test_a_heavy_day_is_written_by_many_tasks(spark, tmp_path):
    days = F.when(F.col("id") % 10 == 0, F.col("id") % 70).otherwise(0)
    rows = spark.range(0, 60_000, 1, 8).select(
        F.concat(F.lit("S"), "id").alias("student_id"), F.lit("CS1").alias("course_code"),
        F.lit("x").alias("interaction_type"),
        (F.lit("2024-01-01 10:00:00").cast("timestamp") + F.make_dt_interval(days)).alias("timestamp"),
        F.lit(None).cast("int").alias("duration"), F.lit(None).cast("string").alias(
            "location_country"), F.lit(None).cast("string").alias("location_city"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "16k")
    try:
        land(rows, f"{tmp_path}/skewed", by_date=True, rebalance=True)
    finally:
        spark.conf.unset(name)
    heavy = [sum(1 for _ in file.open()) for file in
             (tmp_path / "skewed" / "event_date=2024-01-01").glob("*.json")]
    assert len(heavy) > 4 and max(heavy) < 4 * sorted(heavy)[len(heavy) // 2]
    assert read_landed(spark, f"{tmp_path}/skewed").count() == 60_000


def test_bounds_need_a_landing_by_date(spark, tmp_path):
    rows = interactions(spark, [("S1", "CS1", "x", "2024-01-01 10:00:00")])
    land(rows, f"{tmp_path}/flat")
    land(rows, f"{tmp_path}/dated", by_date=True)
    land(rows, f"{tmp_path}/mixed", by_date=True)
    (tmp_path / "mixed" / "log_1.json").write_text("{}")
    for path in ("flat", "mixed", "none", "dated/*"):
        with pytest.raises(ValueError, match="event_date"):
            read_landed(spark, f"{tmp_path}/{path}", since=date(2024, 1, 1))
    assert read_landed(spark, f"{tmp_path}/dated", until=date(2024, 1, 1)).count() == 1
    assert read_landed(spark, f"{tmp_path}/dated", until=date(2023, 1, 1)).count() == 0


BAD = ["junk", '{"student_id":"S9","course_code":"C"}', '{"course_code":"C"}',
       '{"course_code":"C","duration":"abc"}']


def test_loading_accounts_for_every_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "log.json").write_text(
        "\n".join([json.dumps(e) for e in TWO] + BAD + [json.dumps(TWO)]))
    tables = Tables(spark, f"{tmp_path}/tables")
    moved = ingest_landed(spark, f"{tmp_path}/in", tables)
    assert (moved.taken, moved.aside) == (5, 3)
    aside = spark.read.parquet(f"{moved.folder}/*").collect()
    assert sorted((r.reason, r.payload) for r in aside) == [
        ("ill_typed", BAD[3]), ("malformed", "junk"), ("no_student", aside_of(BAD[2], aside))]
    assert [r.student_id for r in tables.interaction_logs.rejected().collect()] == ["S9"]
    assert tables.interaction_logs.latest().count() == 2


def aside_of(text, rows):
    """The payload with the same course and no student: JSON again, with all fields."""
    payload, = [r.payload for r in rows if r.reason == "no_student"]
    assert json.loads(payload)["course_code"] == json.loads(text)["course_code"]
    return payload


def test_ingest_and_replay_jobs(spark, tmp_path):
    feed = messages(spark, [json.dumps(e) for e in TWO] + BAD)
    moved = replay_to_landing(feed, f"{tmp_path}/landing")
    assert (moved.taken, moved.aside) == (3, 3)
    assert spark.read.parquet(f"{moved.folder}/*").count() == 3
    tables = Tables(spark, f"{tmp_path}/tables")
    for _ in range(2):
        assert ingest_landed(spark, f"{tmp_path}/landing", tables)[:2] == (3, 0)
    assert [r.student_id for r in tables.interaction_logs.in_key_order().collect()] == ["S1", "S2"]


def test_landed_stream_quarantine(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "log.json").write_text("\n".join([json.dumps(e) for e in TWO] + BAD))
    lines = stream_landed(spark, f"{tmp_path}/in")
    await_all(start_quarantine(unusable_landed(lines), f"{tmp_path}/q", f"{tmp_path}/cp",
                               {"availableNow": True}))
    assert sorted(r.reason for r in spark.read.parquet(f"{tmp_path}/q").collect()) == [
        "ill_typed", "malformed", "no_student"]
