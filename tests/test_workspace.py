import pytest

from coursepulse import workspace
from coursepulse.sinks import publish
from coursepulse.sources import build_session, kafka_options, stream_messages
from helpers import interactions


def test_shared_root_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert workspace.shared_root(spark) == configured.rstrip("/")
    assert workspace.shared_root(spark) == workspace.shared_root(spark)
    first, second = (workspace.working_dir(spark, "x") for _ in range(2))
    assert first != second and first.startswith(workspace.shared_root(spark))


class _Conf:
    def get(self, name, default=None):
        return default


class _Cluster:
    conf = _Conf()

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_root(_Cluster())


def test_settings_are_restored_even_on_failure(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError):
        with workspace.session_conf(spark, {"spark.sql.shuffle.partitions": 3, "my.own": 1}):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("my.own", None) is None


def test_small_files(spark, tmp_path):
    assert workspace.file_names(spark, f"{tmp_path}/none") == []
    path = f"{tmp_path}/a/b/c"
    workspace.put_text(spark, path, "other")
    workspace.put_text(spark, path, "äx")
    assert workspace.read_text(spark, path) == "äx"
    workspace.put_text(spark, f"{tmp_path}/a/d", "")
    assert [p.rsplit("/", 1)[1] for p in workspace.matching(spark, f"{tmp_path}/a/*/c")] == ["c"]
    assert workspace.matching(spark, f"{tmp_path}/none/*") == []
    workspace.delete_folder(spark, path, str(tmp_path))
    assert {n for n in workspace.file_names(spark, f"{tmp_path}/a")} == {"d"}


def test_session_takes_caller_settings(spark):
    session = build_session("x", {"spark.sql.session.timeZone": "UTC", "my.setting": "7"})
    assert session.conf.get("my.setting") == "7"
    session.conf.unset("my.setting")


def test_kafka_options():
    assert kafka_options("h:1", "t", minPartitions=64) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "minPartitions": "64"}


def test_topics_need_the_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        stream_messages(spark, "h:1")
    rows = interactions(spark, [("a", "C", "x", "2024-01-01 00:00:00")])
    with pytest.raises(Exception, match="kafka"):
        publish(rows, "h:1")
