"""Work tables in the folder that all executors share.

A written table cuts lineage and survives the loss of executors, and being columnar it lets
later passes read only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a checkpoint folder set on the context serves, or in local mode a
    temporary folder that goes with the process. A cluster without a shared folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    key = context.applicationId
    if key not in _local_folders:
        _local_folders[key] = tempfile.TemporaryDirectory(prefix="siftwell-")
    return _local_folders[key].name


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a work table."""
    return f"{shared_folder(spark)}/siftwell-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder; returns the stored table and its path."""
    path = work_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
    except BaseException:
        discard(df.sparkSession, path)
        raise
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a work table."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
