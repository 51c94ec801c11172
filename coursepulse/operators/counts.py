"""Interaction counts per (student, course) and what recommendations derive from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursepulse.workspace import stored, working_dir


def interaction_counts(interactions: DataFrame) -> DataFrame:
    """Typed interactions and last event per (student, course).

    Interactions without a type do not count, but keep their pair (with 0).
    """
    return interactions.groupBy("student_id", "course_code").agg(
        F.count("interaction_type").alias("interaction_count"),
        F.max("timestamp").alias("timestamp"),
    )


def last_seen(counts: DataFrame) -> DataFrame:
    """Last event per student."""
    return counts.groupBy("student_id").agg(F.max("timestamp").alias("timestamp"))


def numbered(rows: DataFrame, name: str, folder: str, first: int = 0) -> DataFrame:
    """Sorted ``rows`` with their place in the order as ``name``, from ``first`` on.

    A row's number is its position inside its range of the sort plus the sizes of the ranges before
    it: nothing visits the driver and no task sorts more than its own range. Positions are written
    out before they are added up, so offsets and rows come from the same files even if an executor
    is lost in between.
    """
    tagged = F.monotonically_increasing_id()  # partition number above 33 bits of position
    placed = stored(
        rows.withColumn("tagged", tagged).select(
            *rows.columns, F.shiftright("tagged", 33).alias("part"),
            F.col("tagged").bitwiseAND(F.lit((1 << 33) - 1)).alias("position")), folder)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    # One row per partition of the sort above, so this window and the broadcast are always small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").select(
        *rows.columns, (F.col("offset") + F.col("position") + first).alias(name))


def dense_index(pairs: DataFrame, label: str, index: str, folder: str | None = None) -> DataFrame:
    """Number the labels 0..n-1, most pairs first, ties in label order: ``label, index``.

    The numbered table is written, so joins know its true size.
    """
    folder = folder or working_dir(pairs.sparkSession, f"index-{label}")
    ranked = pairs.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.asc(label)).select(label)
    placed = numbered(ranked, index, f"{folder}/placed")
    return stored(placed.withColumn(index, F.col(index).cast("int")), f"{folder}/numbered")
