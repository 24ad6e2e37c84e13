"""Tables written between the steps of a plan, for results that several steps read."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="addrloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def staging_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Only a local session gets one of its own."""
    folder = spark.conf.get(FOLDER_SETTING, None)
    if folder is None and spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        folder = _local_folder()
    if folder is None:
        raise RuntimeError(f"set {FOLDER_SETTING} to a folder that the driver and all executors share")
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    Later steps read only the columns they need, and the loss of an executor repeats
    no earlier step. Runs one job now.
    """
    folder = staging_folder(df.sparkSession)
    path = f"{folder.rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
