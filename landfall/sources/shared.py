"""The folder that driver and executors share, for work between two jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; in local mode one of our own if unset."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="landfall-"))
    return spark.sparkContext.getCheckpointDir()


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint`` has a folder to write to."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def _hadoop(spark: SparkSession, path: str):
    """The file system a path lies in, and the path as that system takes it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _hadoop(spark, path)
    return files.exists(place)


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a folder nobody has used, below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The frame written down once, for as long as the block runs.

    A source that cannot be read twice with the same result, as a table that
    changes, is read once; later jobs see one state of it and do not depend on
    executors that may be lost.
    """
    spark = df.sparkSession
    path = new_folder(spark, "staged")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        files, place = _hadoop(spark, path)
        files.delete(place, True)
