"""Shared working folders, folder listings and scoped session settings."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return root.rstrip("/")


def working_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared root (not created yet)."""
    return f"{shared_root(spark)}/coursepulse/{label}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written to ``path`` and read back: lineage ends at the files, and their size is
    known to whoever joins them."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ensure_rdd_checkpoints(spark: SparkSession) -> None:
    """Let iterative estimators cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(spark)}/coursepulse/rdd")


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop_path(spark, path)
    return fs.exists(jpath)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop_path(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder, by one listing; none if there is no folder."""
    fs, jpath = _hadoop_path(spark, path)
    try:
        return [status.getPath().getName() for status in fs.listStatus(jpath)]
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception.getClass().getName()):
            return []
        raise


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, jpath = _hadoop_path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(jpath) or ()]


def file_sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Paths that match a glob pattern, with the files' lengths; hidden ones are left out."""
    fs, jpath = _hadoop_path(spark, pattern)
    found = {status.getPath().toString(): status.getLen() for status in fs.globStatus(jpath) or ()}
    return {path: size for path, size in found.items() if path.rsplit("/", 1)[1][0] not in "._"}


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of one of that name."""
    fs, jpath = _hadoop_path(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, jpath = _hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete_folder(spark: SparkSession, path: str, upto: str | None = None) -> None:
    """Delete a file or folder, and the folders above it, below ``upto``, that are then empty."""
    fs, jpath = _hadoop_path(spark, path)
    fs.delete(jpath, True)
    parent = path.rsplit("/", 1)[0]
    if upto and parent != upto and parent.startswith(upto) and not file_names(spark, parent):
        delete_folder(spark, parent, upto)


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, object]) -> Iterator[None]:
    """Apply SQL settings for the duration of a block, then restore the caller's values.

    A streaming query copies the session at ``start()``, so settings in force around the start
    stay with the query without leaking into the caller's session.
    """
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
