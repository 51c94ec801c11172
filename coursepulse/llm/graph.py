"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.folders import working_dir
from coursepulse.workspace import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component``: every linked id, with the smallest id it can reach.

    Alternates two steps until nothing moves: each id hands its larger neighbours to its smallest
    one, then its smaller neighbours too. Paths shorten geometrically, and a hub is only ever
    aggregated and joined, never gathered. Each round's links are a written table.
    """
    spark = links.sparkSession
    edges = stored(
        links.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        working_dir(spark, "links"))
    before, last = None, edges
    while True:
        edges = stored(_small_star(_large_star(edges)), working_dir(spark, "links"))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if not now[0] or now == before and edges.join(last, ["u", "v"], "left_anti").isEmpty():
            break
        before, last = now, edges
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    heads = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.unionByName(heads)


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of an id to the smallest of its neighbourhood, which is a written
    table: below the plain join that follows, Spark can split a hub's rows, or send the table."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")),
                   working_dir(edges.sparkSession, "least"))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of an id, and the id, to the smallest of them."""
    edges = stored(edges, working_dir(edges.sparkSession, "links"))
    least = stored(edges.groupBy("u").agg(F.min("v").alias("least")),
                   working_dir(edges.sparkSession, "least"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("least")).select(
        F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionAll(least.select("u", F.col("least").alias("v"))).distinct()
