"""A corpus pipeline: quality, toxicity, near duplicates, test-set leaks, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the one before kept; all but the
last return the columns of ``documents``.

The stages share executors, whose Python processes keep what memory they once had. So each has Spark
hand over ``BATCH_ROWS`` rows at a time, a tenth of the default; the setting stays with the session, since
a stage's result is computed after its function has returned.
"""

from __future__ import annotations

import functools

import public_tokenizers

from coursepulse.llm.bpe import round_trip_digests
from coursepulse.llm.decontaminate import drop_contaminated
from coursepulse.llm.folders import working_dir
from coursepulse.llm.minhash_dedup import drop_near_duplicates
from coursepulse.llm.quality import reject_low_quality
from coursepulse.llm.queries import VOCABULARY, read
from coursepulse.llm.toxicity import reject_toxic
from coursepulse.workspace import stored

#: Rows of whole texts that a Python task is given at once.
BATCH_ROWS = 1000


def small_batches(stage):
    @functools.wraps(stage)
    def run_stage(spark, docs, sf_dir):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)
    return run_stage


@small_batches
def quality(spark, docs, sf_dir):
    return reject_low_quality(docs, read(spark, sf_dir, "labels"))


@small_batches
def toxicity(spark, docs, sf_dir):
    return reject_toxic(docs, read(spark, sf_dir, "labels"))


@small_batches
def near_duplicates(spark, docs, sf_dir):
    return drop_near_duplicates(docs)


@small_batches
def decontamination(spark, docs, sf_dir):
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


@small_batches
def tokens(spark, docs, sf_dir):
    return round_trip_digests(
        docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The classifiers are fitted, so SQL can't state the rows; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage; each stage is a written table that the next one reads."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), working_dir(spark, f"pipeline-{name}"))
    return docs
