"""Bounded labelled samples, and models fitted on them in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.text import id_fold


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, folds: int,
                    test_fold: int, most_rows: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``most_rows`` labelled rows outside the test fold.

    Rows are chosen by a hash of their id, so the choice depends on neither order nor partitions.
    An id with several labels counts with the largest, one with several texts with that of the largest
    hash, and repeated rows are one. Rows without id or label are left out.
    """
    fold = id_fold("doc_id", folds)
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & (fold != test_fold))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    )
    # at most most_rows rows of two numbers: small at any size of the input
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    text = F.struct(F.xxhash64("text").alias("hash"), "text")
    return found.groupBy("doc_id").agg(F.max(text).alias("found"), F.first("label").alias("label")
                                       ).select("doc_id", "found.text", "label")


def fit_in_task(rows: DataFrame, fit: Callable[[pd.DataFrame], object]) -> object:
    """The result of ``fit`` over the rows, which must be a bounded sample; None without rows."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [pickle.dumps(fit(group))]})

    found = rows.groupBy(F.lit(0).alias("all")).applyInPandas(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None
