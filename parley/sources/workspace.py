"""Where a job may put tables that outlive a stage."""

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one in local mode only."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{SETTING} is not set: a shared folder is needed on a cluster")
    folder = tempfile.mkdtemp(prefix="parley-")
    spark.conf.set(SETTING, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder and read back: the work before it is not
    repeated when the result is read many times or when executors are lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of tables that nothing names any more. It does so when the driver's garbage
    is collected, which otherwise may be long after; until then they stand beside what is written next. What the first
    collection frees of the Python side's tables is garbage of the second."""
    gc.collect()
    for pause in (1, 0):
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)
