"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(path, file system) as the JVM has them."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder in ``spark.checkpoint.dir``.

    Where that is unset, below the context's checkpoint folder, or else below the
    warehouse: folders that all machines of a cluster see.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_exists(spark: SparkSession, path: str) -> bool:
    where, files = file_system(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by :func:`new_folder` with all that is in it."""
    where, files = file_system(spark, path)
    files.delete(where, True)
