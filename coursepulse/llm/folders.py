"""Working folders of the corpus operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

from coursepulse import workspace


def working_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names.

    A session of one process that names none, as in tests, gets a folder of its own, which goes when
    the process ends. On a cluster the setting is needed, and missing it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.split("[")[0] == "local":
        own = tempfile.mkdtemp(prefix="coursepulse-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    return workspace.working_dir(spark, label)
