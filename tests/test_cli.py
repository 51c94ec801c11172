import pytest

from coursepulse import model
from coursepulse.__main__ import main
from coursepulse.plans import Tables
from coursepulse.sinks import land
from helpers import interactions


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cli") / "landing")
    rows = [(f"S1000{s}", f"{prefix}10{s % 2}", "course_viewed", f"2024-01-01 1{s}:00:00")
            for s in range(5) for prefix in ("CS", "MA", "PE", "HI")]
    land(interactions(spark, rows), path)
    return path


def test_popularity_then_top(spark, landed, tmp_path, capfd):
    main(["popularity", "--landed", landed, "--root", f"{tmp_path}/t", "--checkpoints",
          f"{tmp_path}/c", "--once", "--state-partitions", "2"])
    tables = Tables(spark, f"{tmp_path}/t")
    # One second per student: the log's key keeps one event of each.
    assert tables.interaction_logs.latest().count() == 5
    assert tables.course_popularity().windows().count() == 20
    main(["compact", "--root", f"{tmp_path}/t"])
    main(["top", "--root", f"{tmp_path}/t", "--since", "2024-01-01T12:00", "--until", "2024-01-01T13"])
    main(["top", "--root", f"{tmp_path}/t", "-n", "3"])
    main(["popularity", "--landed", landed, "--root", f"{tmp_path}/t", "--checkpoints",
          f"{tmp_path}/c", "--once"])
    assert tables.course_popularity().windows().count() == 20


def test_load_then_stream_into_one_log(spark, landed, tmp_path):
    """Two commands that number their batches alike share one root."""
    one, two = f"{tmp_path}/one", f"{tmp_path}/two"
    land(interactions(spark, [("S1", "CS1", "x", "2024-01-01 10:00:00"),
                              ("S2", "CS1", "x", "2024-01-01 10:00:00")]), one)
    land(interactions(spark, [("S3", "CS1", "course_viewed", "2024-01-01 10:00:00"),
                              ("S4", "CS1", "y", "2024-01-01 10:00:00")]), two)
    with open(f"{two}/bad.json", "w") as file:
        file.write("junk\n")
    root = f"{tmp_path}/t"
    main(["load", "--landed", one, "--root", root])
    main(["popularity", "--landed", two, "--root", root, "--checkpoints", f"{tmp_path}/c", "--once",
          "--exact", "--window", "1 day", "--watermark", "2 hours", "--weight", "course_viewed=9",
          "--files-per-trigger", "1", "--quarantine", f"{tmp_path}/q", "--state-partitions", "2"])
    tables = Tables(spark, root)
    assert sorted(r.student_id for r in tables.interaction_logs.latest().collect()) == [
        "S1", "S2", "S3", "S4"]
    window, = tables.course_popularity("update", True, "1 day").windows().collect()
    assert (window.active_users, window.engagement_score) == (2, 9)
    assert [r.payload for r in spark.read.parquet(f"{tmp_path}/q").collect()] == ["junk"]


def test_load_and_recommend(spark, landed, tmp_path):
    main(["load", "--landed", landed, "--root", f"{tmp_path}"])
    main(["recommend", "--landed", landed, "--root", f"{tmp_path}", "--top", "2"])
    tables = Tables(spark, f"{tmp_path}")
    assert tables.interaction_logs.latest().count() == 5
    assert tables.student_recommendations.latest().count() == 10


def test_jobs_into_an_external_store(spark, landed, tmp_path):
    """Parquet folders stand in for the store: appends without the store's upsert."""
    target = ["--root", f"{tmp_path}/t", "--store-format", "parquet",
              "--store-option", f"path={tmp_path}/{{table}}"]
    main(["popularity", "--landed", landed, *target, "--checkpoints", f"{tmp_path}/c",
          "--mode", "complete", "--exact", "--once", "--state-partitions", "2"])
    log = spark.read.parquet(f"{tmp_path}/interaction_logs")
    assert log.count() == 5 and log.columns == model.INTERACTION_LOGS.columns
    courses = spark.read.parquet(f"{tmp_path}/course_popularity")
    assert courses.columns == model.COURSE_POPULARITY.columns
    assert courses.distinct().count() == 8
    main(["recommend", "--landed", landed, *target, "--top", "2"])
    recommended = spark.read.parquet(f"{tmp_path}/student_recommendations")
    assert recommended.columns == model.STUDENT_RECOMMENDATIONS.columns
    assert sorted(recommended.collect()) == sorted(
        Tables(spark, f"{tmp_path}/t").student_recommendations.latest().collect())


def test_profile(spark, landed):
    main(["--conf", "spark.sql.session.timeZone=UTC", "profile", "--landed", landed])


@pytest.mark.parametrize("arguments", [
    ["publish", "--servers", "h:1", "--landed", "x", "--quarantine", "aside", "--topic-option", "kafka.acks=all"],
    ["land", "--servers", "h:1", "--to", "x"],
    ["popularity", "--servers", "h:1", "--root", "x", "--checkpoints", "y"],
])
def test_topics_need_the_connector(spark, landed, tmp_path, arguments):
    places = {"x": landed, "aside": f"{tmp_path}/aside"}
    arguments = [places.get(a, a) for a in arguments]
    with pytest.raises(Exception, match="kafka"):
        main(arguments)


def test_a_source_is_required():
    with pytest.raises(SystemExit):
        main(["popularity", "--root", "x", "--checkpoints", "y"])
