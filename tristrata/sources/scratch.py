"""Intermediate tables in the folder the cluster shares.

Lineage is cut by writing a Parquet table under ``spark.checkpoint.dir``: unlike an RDD
checkpoint it stays columnar, so a later pass that needs one column reads one column, and it
outlives any executor.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tristrata.sources import fs

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables of this application."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tristrata-")
        root = _local_folders[context.applicationId]
    return f"{root.rstrip('/')}/tristrata/{context.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of the writes inside as soon as each is done.

    A written table is read from its files from then on, so nothing needs them any more.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def table(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this application."""
    fs.delete(spark, folder(spark))
